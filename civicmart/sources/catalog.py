"""The five built-in categories."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.cleaning import UNKNOWN_PLACE, ColumnRule
from .spec import SourceSpec, text_fields


def _number(raw: str, target: str, kind: str = "int") -> ColumnRule:
    return ColumnRule((raw,), target, kind)


def _place(raw: str, target: str, sentinel: str | None = UNKNOWN_PLACE) -> ColumnRule:
    return ColumnRule((raw,), target, hyphens=True, sentinel=sentinel)


def _text(raw: str, target: str) -> ColumnRule:
    return ColumnRule((raw,), target)


# Category, file and field names as published by the open-data portal,
# and the names of the formatted columns.

INCOME = SourceSpec(
    category="income",
    table="income",
    file_format="csv",
    raw_schema=text_fields(
        "Any",
        "Codi_Districte",
        "Nom_Districte",
        "Codi_Barri",
        "Nom_Barri",
        "Població",
        "Índex RFD Barcelona = 100",
    ),
    rules=(
        _number("Codi_Districte", "district_code"),
        _place("Nom_Districte", "district_name"),
        _number("Any", "year"),
        _number("Índex RFD Barcelona = 100", "RDF_index", "double"),
        _number("Codi_Barri", "neighborhood_code"),
        _place("Nom_Barri", "neighborhood_name"),
        _number("Població", "population"),
    ),
)

DENSITY = SourceSpec(
    category="density",
    table="density",
    file_format="json",
    raw_schema=text_fields(
        "Any",
        "Codi_Barri",
        "Codi_Districte",
        "Densitat (hab/ha)",
        "Densitat neta (hab/ha)",
        "Nom_Barri",
        "Nom_Districte",
        "Població",
        "Superfície (ha)",
        "Superfície Residencial (ha)",
        "info",
    ),
    rules=(
        _number("Any", "year"),
        _number("Codi_Barri", "neighborhood_code"),
        _number("Codi_Districte", "district_code"),
        _number("Densitat (hab/ha)", "density", "double"),
        _number("Densitat neta (hab/ha)", "net_density", "double"),
        _place("Nom_Barri", "neighborhood_name"),
        _place("Nom_Districte", "district_name"),
        _number("Població", "population"),
        _number("Superfície (ha)", "area", "double"),
        _number("Superfície Residencial (ha)", "residential_area", "double"),
    ),
    marker="info",
    whole_file=True,
)

IMMIGRANTS = SourceSpec(
    category="immigrants",
    table="immigrants",
    file_format="json",
    raw_schema=text_fields(
        "Any",
        "Codi_Barri",
        "Codi_Districte",
        "EDAT_Q",
        "NACIONALITAT_G",
        "Nom_Barri",
        "Nom_Districte",
        "SEXE",
        "Valor",
    ),
    rules=(
        _number("Any", "year"),
        _number("Codi_Barri", "neighborhood_code"),
        _number("Codi_Districte", "district_code"),
        _number("EDAT_Q", "age_group"),
        _number("NACIONALITAT_G", "nationality_group"),
        _place("Nom_Barri", "neighborhood_name"),
        # The unknown label stays in this one column of this one table.
        _place("Nom_Districte", "district_name", sentinel=None),
        _number("SEXE", "gender"),
        _number("Valor", "value", "double"),
    ),
)

UNEMPLOYMENT = SourceSpec(
    category="unemployment",
    table="unemployment",
    file_format="json",
    raw_schema=StructType(
        [
            StructField("help", StringType()),
            StructField("success", StringType()),
            # As text, whether it is a structure or a sentence.
            StructField("error", StringType()),
            StructField(
                "result",
                StructType(
                    [
                        StructField("resource_id", StringType()),
                        StructField("total", StringType()),
                        StructField("fields", ArrayType(text_fields("id", "type"))),
                        StructField("_links", text_fields("start", "next")),
                        StructField(
                            "records",
                            ArrayType(
                                text_fields(
                                    "_id",
                                    "Any",
                                    "Mes",
                                    "Codi_Districte",
                                    "Nom_Districte",
                                    "Codi_Barri",
                                    "Nom_Barri",
                                    "Sexe",
                                    "Demanda_ocupació",
                                    "Demanda_ocupacio",
                                    "Nombre",
                                )
                            ),
                        ),
                    ]
                ),
            ),
        ]
    ),
    rules=(
        _number("Codi_Districte", "district_code"),
        _place("Nom_Districte", "district_name"),
        _number("Any", "year"),
        _number("Codi_Barri", "neighborhood_code"),
        _place("Nom_Barri", "neighborhood_name"),
        _number("Nombre", "count"),
        _text("Sexe", "gender"),
        # Accented up to 2018, plain from 2019.
        ColumnRule(("Demanda_ocupació", "Demanda_ocupacio"), "job_demand"),
        _number("Mes", "month"),
    ),
    records="result.records",
    marker="error",
)

LOOKUP_TABLES = SourceSpec(
    category="lookup_tables",
    table="names_lookup",
    file_format="csv",
    raw_schema=text_fields(
        "district",
        "neighborhood",
        "district_n_reconciled",
        "district_n",
        "district_id",
        "neighborhood_n_reconciled",
        "neighborhood_n",
        "neighborhood_id",
    ),
    rules=(
        _text("district", "district_name"),
        _text("neighborhood", "neighborhood_name"),
        _text("district_n_reconciled", "district_name_reconciled"),
        _text("district_n", "district_name_normalized"),
        _text("district_id", "district_id"),
        _text("neighborhood_n_reconciled", "neighborhood_name_reconciled"),
        _text("neighborhood_n", "neighborhood_name_normalized"),
        _text("neighborhood_id", "neighborhood_id"),
    ),
    only_file="income_opendatabcn_extended.csv",
)

CATALOG: tuple[SourceSpec, ...] = (INCOME, DENSITY, IMMIGRANTS, UNEMPLOYMENT, LOOKUP_TABLES)
