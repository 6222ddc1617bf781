import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from weirflow.llm import idcoder
from weirflow.llm.tokens import tokenizer_json


@pytest.mark.parametrize("n", [0, 1, 2, 63, 65, 127, 200, 5_000, 300_001])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    kinds = [
        rng.integers(0, 49_408, n),
        rng.zipf(1.3, n) % 49_408,
        np.arange(n) % 7,
        np.zeros(n, int),
        np.full(n, idcoder.LARGEST - 1),
    ]
    for ids in kinds:
        alphabet, used, data = idcoder.encode_ids(ids.astype("<u4"))
        assert (idcoder.decode_ids(n, alphabet, used, data) == ids).all()


def test_repetition_and_skew_are_coded_in_few_bits():
    rng = np.random.default_rng(1)
    for ids, most in ((np.arange(200_000) % 50, 1.0), (rng.integers(0, 16, 200_000), 4.6)):
        _, used, data = idcoder.encode_ids(ids.astype("<u4"))
        assert 8 * (len(data) + 4 * len(used)) / len(ids) < most


def test_ids_beyond_the_alphabet():
    with pytest.raises(ValueError, match="more bits"):
        idcoder.encode_ids(np.array([idcoder.LARGEST], "<u4"))


def test_rows_of_several_blocks_and_damage(monkeypatch):
    monkeypatch.setattr(idcoder, "BLOCK_IDS", 100)
    ids = np.random.default_rng(2).integers(0, 1000, 1_234).astype("<u4").tobytes()
    row = idcoder.pack_row([5, None, 7], [1_000, 0, 234], ids)
    assert idcoder.unpack_row(row) == ([5, None, 7], [1_000, 0, 234], ids)
    broken = bytearray(row)
    broken[-40] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        idcoder.unpack_row(bytes(broken))
    with pytest.raises(ValueError, match="not a row"):
        idcoder.unpack_row(b"XXXX" + row[4:])


def brute(rows):
    full, at, out = Tokenizer.from_str(tokenizer_json()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(full.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_documents_are_described_from_the_files(docs_of, monkeypatch):
    monkeypatch.setattr(idcoder, "BLOCK_IDS", 50)
    rows = [(i, f"text number {i} " * (i % 9)) for i in range(60)]
    rows += [(None, "no id"), (200, None), (201, ""), (202, "word " * 3_000)]
    found = idcoder.encode_documents(docs_of(rows)).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == brute(rows)


def test_repeated_ids_are_documents_of_their_own(docs_of):
    found = idcoder.encode_documents(docs_of([(1, "a b"), (1, "a b"), (1, "c")])).orderBy("start").collect()
    assert [r.doc_id for r in found] == [1, 1, 1]
    assert sorted(r.n_tokens for r in found) == [2, 3, 3]
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]


def test_empty_table(docs_of):
    assert idcoder.encode_documents(docs_of([(1, "x")]).where("false")).collect() == []


def test_ids_can_be_read_back(spark, docs_of, tmp_path):
    idcoder.write_ids(docs_of([(2, "hello world"), (1, None)]), str(tmp_path / "ids"))
    found = idcoder.read_ids(spark.read.parquet(str(tmp_path / "ids"))).orderBy("doc_id").collect()
    full = Tokenizer.from_str(tokenizer_json())
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == [[1], full.encode("hello world").ids + [1]]
