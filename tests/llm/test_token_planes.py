import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import awkward, documents, shipped  # noqa: F401
from tokenizers import Tokenizer

from civicmart.llm import token_planes as tp

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return tp.Encoder(PATH)


def test_parts_encode_as_whole_texts(encoder):
    rng = random.Random(2)
    pieces = list("aÀßÿ×9'.,!é’ſΣς <|> ̈\u0085 \u001c\n\t\r12中😀İK") + ["<|endoftext|>", "'ll", "<|start", "don't", "  ", "...", "it's."]
    for _ in range(6000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        assert encoder.check(text), repr(text)


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(tp, "KEPT", 10_000)
    encoder = tp.Encoder(PATH)
    for k in range(40):
        assert encoder.check(" ".join(f"word{i}" for i in range(k, k + 20)))


@pytest.mark.parametrize("bits", [1, 7, 16, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1001])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
    assert (tp.from_planes(tp.to_planes(ids, bits, 64), n, bits, 64) == ids).all()


def expected(pairs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in pairs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_report_equals_the_tokenizer(documents):
    rng = random.Random(6)
    words = ["the", "Über", "été,", "x-9", "don't", "\n", "."] + [f"w{i}" for i in range(50)]
    pairs = [(i * 3 % 211, " ".join(rng.choices(words, k=rng.randint(0, 90)))) for i in range(211)]
    got = sorted(tuple(r) for r in tp.token_report(documents(pairs), PATH).collect())
    assert got == expected(sorted(pairs))


def test_awkward_rows(awkward):
    got = tp.token_report(awkward, PATH).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == sorted((r.doc_id for r in awkward.collect()), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in by_start] == [0, *np.cumsum([r.n_tokens for r in by_start])[:-1]]
    sizes = sorted(x[2:] for x in expected([(r.doc_id, r.text) for r in awkward.collect()]))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sizes


def test_empty_table(documents):
    assert tp.token_report(documents([(1, "a")]).limit(0), PATH).count() == 0
