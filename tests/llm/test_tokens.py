"""Token counts and token-id output against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import byte_ids, fst_tokens
from quire.llm.queries import tokenizer_path
from tests.llm.fixtures import clashing, documents, frame


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def counter():
    return fst_tokens.Counter(tokenizer_path())


PARTS = st.one_of(st.text(max_size=8), st.sampled_from(["'s", "'re", "'ll", "'S", "ing", "the", " ", "\n", " ", "\x85", "12", "!?", "é", "İ", "ΑΣ",
                                                       "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "日本", "½", "a" * 300]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=8).map("".join), min_size=1, max_size=4))
def test_counts_equal_the_library(counter, library, texts):
    assert counter(texts).tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("first,end", [(1, 0x3000), (0x3000, 0xD800), (0xE000, 0x10000), (0x10000, 0x20000), (0x1FFF0, 0x20010), (0x2F800, 0x30010), (0xE0000, 0xE0200)])
def test_every_code_point_is_read_as_the_library_reads_it(counter, library, first, end):
    texts = [f"a{chr(c)}b{chr(c)} \u0130{chr(c)}" for c in range(first, end)]
    assert counter(texts).tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_states_compose_across_chunks(counter, library):
    texts = ["it's " * 500 + "x" * 1000 + " we'll!!" * 300, "", "'" * 1000, "a1" * 700]
    assert counter(texts).tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_count_rows(spark, library):
    docs = documents(10, 20)
    got = fst_tokens.count_tokens(clashing(frame(spark, docs)), tokenizer_path(), limit=100).collect()
    want = [(str(d[0]), len((d[1] or "").encode()), len(library.encode(d[1] or "", add_special_tokens=False).ids)) for d in docs]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)
    assert fst_tokens.count_tokens(frame(spark, []), tokenizer_path()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=50))
def test_segments_decode_to_what_was_encoded(ranks):
    control, data = byte_ids.encode(np.array(ranks, np.uint32))
    assert byte_ids.decode(control, data, len(ranks)).tolist() == ranks
    assert len(control) == -(-len(ranks) // 4)


def test_files_hold_the_documents_in_order(spark, library):
    docs = documents(11, 30)
    got = [tuple(r) for r in byte_ids.encode_documents(clashing(frame(spark, docs)), tokenizer_path()).orderBy("start").collect()]
    ids = {d: [*library.encode(d[1] or "", add_special_tokens=False).ids, 2] for d in docs}
    assert [r[0] for r in got] == sorted((d[0] for d in docs), key=lambda x: (x is not None, x or 0))
    at = 0
    for doc_id, start, n, _ in got:
        assert start == at
        at += n
    want = sorted((str(d[0]), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d in docs for x in [ids[d]])
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == want


def test_frequent_ids_come_first(spark):
    docs = frame(spark, documents(11, 30))
    tokenized = byte_ids.tokenize(docs, tokenizer_path(), 2, "doc_id", "text")
    segments, ranks = byte_ids.write_ids(docs, tokenizer_path())
    n = np.zeros(50_000, np.int64)
    for r in tokenized.collect():
        n += np.bincount(np.frombuffer(r["ids"], byte_ids.width(50_000)), minlength=50_000)
    order = n[[r["id"] for r in ranks.orderBy("rank").collect()]]
    assert (np.diff(order) <= 0).all()
    assert segments.selectExpr("sum(length(data))").first()[0] < 1.5 * n.sum()


def test_empty_table(spark):
    assert byte_ids.encode_documents(frame(spark, []), tokenizer_path()).count() == 0


def test_new_pieces_are_tokenized_a_bounded_number_at_once(monkeypatch):
    import pyarrow as pa

    pieces = byte_ids.Pieces(tokenizer_path())
    texts = pa.array([" ".join(f"piece{i}x{j}" for j in range(50)) for i in range(30)] + [None, ""])
    want = pieces(texts)
    pieces.clear()
    tokenizer, asked = pieces.tokenizer, []

    class Counted:
        def encode_batch_fast(self, batch, **more):
            asked.append(len(batch))
            return tokenizer.encode_batch_fast(batch, **more)

    pieces.tokenizer = Counted()
    monkeypatch.setattr(byte_ids, "NEW_PIECES", 64, raising=False)
    got = pieces(texts)
    assert max(asked) <= 64 and sum(asked) == 1500
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, want, strict=True))


def test_rows_reach_the_tokenizer_in_batches_of_few_bytes(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(name), []

    def noted(df, table, **more):
        seen.append((table, spark.conf.get(name)))
        return written(df, table, **more)

    written = byte_ids.written
    monkeypatch.setattr(byte_ids, "written", noted)
    assert byte_ids.encode_documents(frame(spark, documents(3, 10)), tokenizer_path()).count() > 0
    assert [t for t, _ in seen] == ["tokenized", "id-ranks", "ids", "id-rows"]
    assert all(int(x) <= 4 << 20 for _, x in seen) and spark.conf.get(name) == before


def test_later_stages_keep_no_pieces():
    pieces = byte_ids.Pieces.of(tokenizer_path())
    assert byte_ids.Pieces.of(tokenizer_path()) is pieces
    byte_ids.Pieces.forget()
    assert byte_ids.Pieces.of(tokenizer_path()) is not pieces
