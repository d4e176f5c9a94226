"""The four stages over hand-made files of all five categories."""

import json
import math

import pytest
from conftest import rows

from civicmart.operators.search import SearchSpace
from civicmart.operators.sinks import read_runs
from civicmart.plans.zones import (
    Zones,
    collect_stage,
    format_stage,
    run_stages,
    transform_stage,
)
from civicmart.sources.readers import read_json_lines, read_table

INCOME = '"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Població","Índex RFD Barcelona = 100"\r\n'
LOOKUP = (
    "district,neighborhood,district_n_reconciled,district_n,district_id,"
    "neighborhood_n_reconciled,neighborhood_n,neighborhood_id\n"
)


def put(zones, category, name, content):
    from pathlib import Path

    folder = Path(zones.source) / category
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text, encoding="utf-8")


def density(year, code, net, gross="10.5"):
    return {
        "Any": year,
        "Codi_Barri": str(code),
        "Codi_Districte": 5,
        "Densitat (hab/ha)": gross,
        "Densitat neta (hab/ha)": net,
        "Nom_Barri": "x",
        "Nom_Districte": "y",
        "Població": 1,
        "Superfície (ha)": "1.5",
        "Superfície Residencial (ha)": "-",
    }


def immigrant(year, code, value, district="Ciutat-Vella"):
    return {
        "Any": year,
        "Codi_Barri": code,
        "Codi_Districte": 1,
        "EDAT_Q": "3",
        "NACIONALITAT_G": 2,
        "Nom_Barri": "No consta",
        "Nom_Districte": district,
        "SEXE": 1,
        "Valor": value,
    }


def unemployed(spelling, label, *records):
    fields = [
        {
            "Any": str(year),
            "Mes": str(month),
            "Codi_Districte": "1",
            "Nom_Districte": "Ciutat Vella",
            "Codi_Barri": str(code),
            "Nom_Barri": "a-b",
            "Sexe": "Homes",
            spelling: label,
            "Nombre": count,
        }
        for year, month, code, count in records
    ]
    return {"help": "h", "success": True, "result": {"resource_id": "r", "records": fields}}


def write_sources(zones):
    put(
        zones,
        "income",
        "2014.csv",
        INCOME
        + '2014,1,"Ciutat-Vella",1,"el Raval - nord",100,"64.5"\r\n'
        + '2014,1,"Ciutat-Vella",2,"No consta",0,"80"\r\n'
        + '2014,99,"No consta",99,"No consta",879,"-"\r\n',
    )
    put(zones, "income", "2019.csv", INCOME + '2019,1,"Ciutat-Vella",1,"el Raval",200,"70.25"\r\n')
    put(zones, "density", "flat.json", [density(2014, 1, "3.5"), density(2014, 2, 4.5), density(2014, 99, "1")])
    put(zones, "density", "flat2.json", [density("2019", 1, "-", "..")])
    put(zones, "density", "nested.json", {"info": {"v": 1}, "Any": "2014", "Codi_Barri": "1"})
    put(
        zones,
        "immigrants",
        "all.json",
        [immigrant(2014, 1, "10"), immigrant("2014", 1, 5), immigrant(2014, 2, ".."), immigrant(2019, 1, "7", "No consta")],
    )
    put(
        zones,
        "unemployment",
        "2014.json",
        unemployed("Demanda_ocupació", "Atur registrat", (2014, 1, 1, "30"), (2014, 2, 1, "40"), (2014, 1, 2, "5")),
    )
    put(zones, "unemployment", "2014b.json", unemployed("Demanda_ocupació", "Demanda no aturats", (2014, 1, 1, "900")))
    put(zones, "unemployment", "2015.json", {"success": False, "error": {"message": "m", "__type": "t"}})
    put(zones, "unemployment", "2019.json", unemployed("Demanda_ocupacio", "Atur Registrat", (2019, 1, 1, "60")))
    put(zones, "lookup_tables", "income_opendatabcn_extended.csv", LOOKUP + "Ciutat Vella,el Raval,C,ciutat vella,Q1,R,el raval,Q2\n")
    put(zones, "lookup_tables", "other.csv", LOOKUP + "other,other,o,o,Q3,o,o,Q4\n")


@pytest.fixture
def zones(tmp_path):
    return Zones(*[str(tmp_path / name) for name in ("raw", "landing", "formatted", "exploitation")])


EXPECTED_MART = [
    (2014, 1, 1, "Ciutat Vella", 100, 64.5, 10.5, 3.5, 15.0, 70, 0.15, 0.7),
    (2014, 2, 1, "Ciutat Vella", 0, 80.0, 10.5, 4.5, 0.0, 5, None, None),
]


def test_stages_one_to_three(spark, zones):
    write_sources(zones)
    batches = collect_stage(spark, zones)
    assert set(batches) == {"income", "density", "immigrants", "unemployment", "lookup_tables"}
    assert len(set(batches.values())) == 1

    report = format_stage(spark, zones)
    assert report["income"]["rows"] == 4 and report["income"]["rejected_RDF_index"] == 1
    assert report["density"]["rows"] == 4 and report["density"]["rejected_net_density"] == 1
    assert report["immigrants"]["rejected_value"] == 1
    assert report["unemployment"]["rows"] == 5

    income = read_table(spark, zones.table("income"))
    assert income.columns == [
        "district_code", "district_name", "year", "RDF_index", "neighborhood_code",
        "neighborhood_name", "population",
    ]
    assert rows(income, "year", "neighborhood_code")[:3] == [
        (1, "Ciutat Vella", 2014, 64.5, 1, "el Raval   nord", 100),
        (1, "Ciutat Vella", 2014, 80.0, 2, None, 0),
        (99, None, 2014, None, 99, None, 879),
    ]
    immigrants = read_table(spark, zones.table("immigrants"))
    assert rows(immigrants.select("year", "neighborhood_name", "district_name", "value", "age_group")) == [
        (2014, None, "Ciutat Vella", 10.0, 3),
        (2014, None, "Ciutat Vella", 5.0, 3),
        (2014, None, "Ciutat Vella", None, 3),
        (2019, None, "No consta", 7.0, 3),
    ]
    names = read_table(spark, zones.table("names_lookup"))
    assert rows(names.select("district_name", "neighborhood_id")) == [("Ciutat Vella", "Q2")]
    for name in report:
        table = read_table(spark, zones.table(name))
        assert rows(read_json_lines(spark, zones.json_copy(name), table.schema)) == rows(table)

    assert transform_stage(spark, zones) == 2
    mart = read_table(spark, zones.mart)
    assert rows(mart, "year", "neighborhood_code") == EXPECTED_MART
    assert dict(mart.dtypes)["total_unemployed"] == "bigint" and dict(mart.dtypes)["RDF_index"] == "double"


def test_rerunning_and_late_files(spark, zones):
    write_sources(zones)
    for _ in range(2):
        collect_stage(spark, zones)
        format_stage(spark, zones)
        transform_stage(spark, zones)
    assert rows(read_table(spark, zones.mart), "year", "neighborhood_code") == EXPECTED_MART

    put(zones, "density", "late.json", [density(2019, 1, "6.5")])
    assert [c for c, b in collect_stage(spark, zones).items() if b] == ["density"]
    format_stage(spark, zones)
    # The first density row of 2019 has no net density; the late one completes the cell.
    assert transform_stage(spark, zones) == 3
    late = read_table(spark, zones.mart).filter("year = 2019")
    assert rows(late) == [(2019, 1, 1, "Ciutat Vella", 200, 70.25, 10.5, 6.5, 7.0, 60, 0.035, 0.3)]


def test_all_stages_with_training(spark, zones):
    for year in (2011, 2012, 2013):
        income, dens, imm, recs = INCOME, [], [], []
        for code in range(1, 41):
            population, net = 100 + 7 * code + year % 3, 1.0 + code % 9
            income += f'{year},1,"D",{code},"N",{population},"{50 + 2 * net}"\r\n'
            dens.append(density(year, code, str(net)))
            imm.append(immigrant(year, code, str(code % 5)))
            recs.append((year, 1, code, str(code % 7)))
        put(zones, "income", f"{year}.csv", income)
        put(zones, "density", f"{year}.json", dens)
        put(zones, "immigrants", f"{year}.json", imm)
        put(zones, "unemployment", f"{year}.json", unemployed("Demanda_ocupació", "Atur registrat", *recs))
    put(zones, "lookup_tables", "income_opendatabcn_extended.csv", LOOKUP)
    space = SearchSpace(families=("lr", "rf"), rf_numTrees=(3, 5), rf_maxDepth=(3, 4), lr_regParam=(0.001, 0.01))
    report = run_stages(spark, zones, space=space, trials=4)
    assert read_table(spark, zones.mart).count() == 120
    assert report.metrics["test_r2"] > 0.5 and math.isfinite(report.metrics["test_nrmse"])
    assert read_runs(spark, f"{zones.exploitation}/model/runs").count() == 5
