import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import AddedToken, Tokenizer

from cardforge.llm import bpe, token_files
from cardforge.llm.queries import RANKS, TOKENIZER

PIECES = ["'s", "'t", "'re", "'ve", "'ll", "'", "''", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "a", "re", "ll", "é", "1", "²",
          "!", "?", "漢", "\x1c", "\u200b", "x'", "😀", "\u0301", "\r\n", "<|endoftext|>", "Ⅷ", "word", "\x00"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts_to_try():
    rng = random.Random(1)
    out = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    return out + [None, "", "a" * 5000, "ab" * 3000, " " * 3000 + "x", "'" * 2000]


def test_ids_equal_the_library(reference):
    texts = texts_to_try()
    vocab = bpe.vocabulary(RANKS)
    for part in (pa.array(texts), pa.array(texts).slice(777, 3000)):
        ids, bounds = bpe.encode_chunk(part, vocab.slices)
        for i, t in enumerate(part.to_pylist()):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == reference.encode_ordinary(t or ""), t


def test_every_codepoint_class(reference):
    vocab = bpe.vocabulary(RANKS)
    cps = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = ["a" + chr(c) + "1" + chr(c) + "!" + chr(c) + "b" for c in cps]
    ids, bounds = bpe.encode_chunk(pa.array(texts), vocab.slices)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == reference.encode_ordinary_batch(texts, num_threads=2)


def test_cache_restarts(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_SLICES", 20)
    cache = bpe.SliceCache(bpe.vocabulary(RANKS).merge_all)
    for t in ("alpha beta gamma " * 3, "delta beta omega one two three four five six seven eight nine ten " * 2, "alpha beta"):
        ids, _ = bpe.encode_chunk(pa.array([t]), cache)
        assert ids.tolist() == reference.encode_ordinary(t)


def test_documents_digests_offsets_and_round_trip(edge_docs, edge_rows, no_docs, reference):
    got = bpe.encode_documents(edge_docs, RANKS, digests=True).collect()
    want = []
    for i, t, *_ in edge_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    encoded = bpe.encode_documents(edge_docs, RANKS)
    back = bpe.decode_documents(encoded, RANKS).collect()
    assert sorted((tuple(r) for r in back), key=repr) == sorted(((i, t or "") for i, t, *_ in edge_rows), key=repr)
    texts = dict((r[0], (r[1] or "").encode()) for r in edge_rows)
    for r in encoded.where("doc_id is not null").collect():
        ends = r["offsets"][1:] + [len(texts[r["doc_id"]])]
        assert [reference.decode_single_token_bytes(x) for x in r["ids"]] == [texts[r["doc_id"]][a:b]
                                                                               for a, b in zip(r["offsets"], ends)]
    assert bpe.encode_documents(no_docs, RANKS).collect() == []


def test_token_files(edge_docs, edge_rows, no_docs, spark, tmp_path):
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    path = str(tmp_path / "tokens")
    token_files.write_token_files(edge_docs, path, TOKENIZER, end_id=2)
    got = token_files.crc_of_ids(token_files.read_token_files(spark, path)).collect()
    start, want = 0, []
    for i, text, *_ in sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    small = token_files.read_token_files(spark, path, ids=False)
    assert small.columns == ["doc_id", "start", "n_tokens"] and small.count() == len(want)
    empty = str(tmp_path / "none")
    token_files.write_token_files(no_docs, empty, TOKENIZER, end_id=2)
    assert token_files.read_token_files(spark, empty).collect() == []


def test_added_tokens_as_the_library_call(tmp_path, spark):
    t = Tokenizer.from_file(TOKENIZER)
    texts = [*texts_to_try(), "one <|endoftext|> two", "<|endoftext|><|endoftext|>", " <|endoftext|>\n ", "<|endoftext|x|>", "plain"]
    for part in (pa.array(texts), pa.array(texts).slice(777, 3000), pa.array(["plain", None])):
        ids, bounds = token_files.encode_texts(part, TOKENIZER)
        want = t.encode_batch([x or "" for x in part.to_pylist()], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [w.ids for w in want]
    path = str(tmp_path / "tokens")
    docs = spark.createDataFrame([(1, "one <|endoftext|> two"), (2, "next")], "doc_id long, text string")
    token_files.write_token_files(docs, path, TOKENIZER, end_id=2)
    got = token_files.read_token_files(spark, path).orderBy("doc_id").collect()
    assert [(r["start"], r["ids"]) for r in got] == [(0, [505, 220, 50256, 734, 2]), (5, t.encode("next").ids + [2])]


def test_added_tokens_that_take_spaces(tmp_path):
    t = Tokenizer.from_file(TOKENIZER)
    t.add_special_tokens([AddedToken("<|x|>", lstrip=True, rstrip=True), AddedToken("word", single_word=True)])
    path = str(tmp_path / "tokenizer.json")
    t.save(path)
    texts = ["a  <|x|>  b", "words word", "a word\n<|endoftext|> ", "plain", None]
    ids, bounds = token_files.encode_texts(pa.array(texts), path)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
