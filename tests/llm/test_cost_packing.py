import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docshred.llm.cost_packing import Packer, RankBytes, TokenBytes, pack_documents, piece_digest
from docshred.llm.queries import TOKENIZER
from tests.llm.fixtures import empty, frame


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=40), st.sampled_from([16, 64, 1024]))
def test_pieces_cover_every_token_once_without_gaps_or_padding(lengths, capacity):
    pieces = Packer(capacity, 1.0, 1 / capacity).pack(lengths)
    seen, seqs = defaultdict(list), defaultdict(list)
    for doc, start, n, seq, offset in pieces:
        assert n > 0
        seen[doc].append((start, n))
        seqs[seq].append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[doc]):
            assert start == at
            at += size
        assert at == n
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


def test_long_documents_spread_over_sequences_by_cost():
    pieces = Packer(100, 1.0, 0.01).pack([60, 60, 40, 40, 10, 10, 10, 10, 30, 30])
    cost = defaultdict(float)
    for _, _, n, seq, _ in pieces:
        cost[seq] += n + 0.01 * n * n
    assert max(cost.values()) / min(cost.values()) < 1.35


def test_cut_encoding_is_the_whole_text_encoding():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    texts = ["", " ", "  a  b", "it's we'll", "a\n\n b \t c", "é ñ  日本 　 x   y", "<|endoftext|> z", "x \u0085 y",
             "1 2  3,4 .. !", "tab\t x\r\n  y"]
    own = TokenBytes(TOKENIZER).encode(texts)
    assert [np.frombuffer(e, "<u4").tolist() for e in own] == [
        e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_rows_against_the_tokenizer(spark):
    df = frame(spark)
    out = [tuple(r) for r in piece_digest(pack_documents(df, TOKENIZER, group_tokens=2000)).collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in df.collect()]
    assert sum(r[2] for r in out) == sum(len(t) for _, t in ids)
    total = defaultdict(int)
    for _, _, n, _, _, seq, _ in out:
        total[seq] += n
    assert all(n == 1024 or n & (n - 1) == 0 for n in total.values())
    candidates = defaultdict(list)
    for doc, t in ids:
        candidates[doc].append(t)
    for doc, start, n, crc, size, _, _ in out:
        assert any(len(t) == size and zlib.crc32(np.array(t[start:start + n], "<u4").tobytes()) == crc
                   for t in candidates[doc])
    assert pack_documents(empty(spark), TOKENIZER).count() == 0


ODD = ["a  b", " a", "a ", "", "  ", "日本 語 x", "x\n y", "é  ñ ß", "don't  you 're", " ", "a \t b", "\x00\u2028 \u00a0x",
       "<|endoftext|> a<|endoftext|>", "\U0001F600\U0001F468\u200d\U0001F469 x", "e\u0301 \ud7ff", "x" * 20_000, "ab" * 5_000,
       " " * 5_000, "\n" * 3_000, "1234567890" * 500, "!?" * 999]


def test_both_ways_of_taking_ids_equal_the_tokenizer():
    import public_tokenizers
    import pyarrow.parquet as pq
    path = public_tokenizers.path("byte_bpe_50k.json")
    cached = TokenBytes(path)
    ranked = RankBytes(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ODD + [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]
    want = [np.asarray(e.ids, dtype="<u4").tobytes()
            for e in cached.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert cached.encode(texts) == want == ranked.encode(texts)
    cached.held = 1 << 40       # the cache is emptied
    assert cached.encode(texts[:30]) == want[:30] and cached.held < 1 << 30
