from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import ODD, documents
from pyspark.sql import functions as F

from gradeframe.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.read(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def texts(seed, alphabet, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


HAND_MADE = ["", " ", "▁", "a", " a", "  a  b ", "\n\t\r\x0b\x00", "<s>", "</s><unk><0x0A>", "é" * 300, "中文 中", "😀", "́"]
HAND_MADE += [" " * n for n in (2, 15, 16, 17, 33, 700)] + ["a" * 3000, "▁▁ a", "the " * 500, "and" * 400, "thethethand"]


def agrees(model, library, some):
    found = pieces.Encoder(model).encode(some)
    wanted = library.encode(some, add_bos=True, add_eos=True)
    assert [t for t, f, w in zip(some, found, wanted) if ids(f) != w] == []
    decoder = pieces.Decoder(model)
    assert [decoder.decode(f) for f in found] == library.decode(wanted)


def test_hand_made_texts(model, library):
    agrees(model, library, HAND_MADE)


@pytest.mark.parametrize("alphabet", ["ab", " the an\nd", "aeinrst ", "▁ x1.é中😀\x00\t", [chr(i) for i in range(1, 0x3100)]])
def test_random_texts(model, library, alphabet):
    agrees(model, library, texts(1, alphabet, 2000, 40) + texts(2, alphabet, 20, 2000))


def test_long_words(model, library):
    """Beyond the length from which parts are finished one pair at a time."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    agrees(model, library, [w + w for w in texts(3, letters, 10, 9000)] + ["andthe" * 3000, "▁" * 5000])


def test_forgetting_changes_nothing(model):
    some = texts(4, "abcde fghi", 200, 80)
    forgetful = pieces.Encoder(model, most=3)
    assert [forgetful.encode([t])[0] for t in some] == pieces.Encoder(model).encode(some)


def test_decoding_any_ids(model, library):
    rng = random.Random(5)
    decoder = pieces.Decoder(model)
    for _ in range(5000):
        some = [rng.choice([rng.randrange(32000), rng.randrange(3), rng.randrange(3, 259), 259, 29871]) for _ in range(rng.randrange(12))]
        assert decoder.decode(np.array(some, "<u4").tobytes()) == library.decode(some), some


def test_odd_rows(spark, model, library):
    docs = documents(spark, ODD + ["same"] * 5).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) doc_id, 'x' text, '' lang, '' source, 0L n_chars"))
    docs = docs.withColumns({"key": F.lit(1), "ids": F.lit(2), "a.b": F.lit(3)})
    found = pieces.decoded(pieces.encoded(docs, model), model).collect()
    rows = sorted((r.doc_id is not None, r.doc_id or 0, ids(r.ids), r.text) for r in found)
    some = ["" if t is None else t for t in ODD] + ["same"] * 5
    wanted = [(False, 0, library.encode("x", add_bos=True, add_eos=True), "x")]
    wanted += [(True, i, w, library.decode(w)) for i, w in enumerate(library.encode(some, add_bos=True, add_eos=True))]
    assert rows == wanted
    assert pieces.decoded(pieces.encoded(docs.limit(0), model), model).collect() == []


def test_without_edges_and_null_ids(spark, model):
    docs = documents(spark, ["a", None])
    bare = {r.doc_id: ids(r.ids) for r in pieces.encoded(docs, model, edges=False).collect()}
    assert bare == {0: [pieces.Pieces.read(MODEL).names.index("▁a")], 1: []}
    nothing = spark.sql("SELECT CAST(NULL AS BINARY) AS ids")
    assert [tuple(r) for r in pieces.decoded(nothing, model).collect()] == [(None, None)]
    with pytest.raises(ValueError):
        pieces.decoded(nothing.withColumn("text", F.lit("")), model)


def test_other_models_are_refused(tmp_path):
    raw = bytearray(open(MODEL, "rb").read())
    path = tmp_path / "other.model"
    path.write_bytes(raw + b"\x0a\x05\x0a\x01\x20\x18\x04")  # one more piece, of the user's kind
    with pytest.raises(ValueError, match="user"):
        pieces.Pieces.read(str(path))


def test_registered_query(spark, library):
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: tuple(r)[1:] for r in queries.op12_pieces(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        w = library.encode(text, add_bos=True, add_eos=True)
        packed = np.array(w, "<u4").tobytes()
        sums = [hashlib.sha256(b).hexdigest() for b in (packed, library.decode(w).encode())]
        assert found[doc_id] == (len(w), *sums)
