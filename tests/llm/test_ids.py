"""Token ids and pieces: the libraries' own ids, exact round trips, and best code lengths."""

import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tabkit.llm import huffman, pieces, queries
from tabkit.runtime import scratch_path
from tests.llm.frames import edge_docs, edge_rows, empty_docs

pytest.importorskip("public_tokenizers")
VOCABULARY = queries.tokenizer_file("byte_bpe_50k.json")
MODEL = queries.tokenizer_file("piece_bpe_32k.model")


def odd_texts():
    draw = random.Random(3)
    out = ["", "a", " lead", "tail ", "a  b ", "   ", "x\ty\nz", "é日本🙂 🙂🙂", "▁a b", "1234567 89,000.50", "def f(x):\n    return x**2 # don't, it's he'll",
           "https://example.com/a?b=c&d=e", "a b　c", "hello\r\n\r\nworld", "x <|endoftext|> y", "....,,,,!!!!", "a\x00b", "z" * 5000, "\n"]
    return out + ["".join(draw.choice("ab the in er on ation ,.'-_()\n 12éß日*") for _ in range(draw.randrange(60))) for _ in range(1500)]


def test_ids_are_the_library_s():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(VOCABULARY)
    texts = odd_texts()
    ids, ends = huffman.Encoder(open(VOCABULARY, encoding="utf-8").read()).encode(pa.array(texts))
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_pieces_are_the_library_s():
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts()
    ids, ends = pieces.Matcher(pieces.load(MODEL)).encode(pa.array(texts))
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == library.encode(text), text


def test_piece_round_trip(spark):
    vocabulary = pieces.load(MODEL)
    docs = edge_docs(spark)
    back = pieces.decode_pieces(pieces.encode_pieces(docs, vocabulary), vocabulary).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((r[0] or -1, (r[1] or "").replace("▁", " ")) for r in edge_rows())
    assert pieces.encode_pieces(empty_docs(spark), vocabulary).collect() == []
    strange = spark.createDataFrame([([200, 201],), (None,), ([],)], "pieces array<int>")
    assert [r.text for r in pieces.decode_pieces(strange, vocabulary).collect()][1:] == ["", ""]


def shortest_total(counts):
    heap, total = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def test_code_lengths():
    draw = np.random.default_rng(1)
    for n in (2, 3, 17, 300):
        counts = draw.integers(0, 1000, n)
        counts[:2] = 5
        lengths = huffman.code_lengths(counts)
        assert (lengths * counts).sum() == shortest_total(counts.tolist())
    steep = np.array([1 << i for i in range(40)])  # would need 39 bits
    lengths = huffman.code_lengths(steep)
    assert lengths.max() == 16 and sum(2.0 ** -lengths) == 1
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0] and huffman.code_lengths(np.array([0])).tolist() == [0]
    codes, seen = huffman.canonical_codes(lengths), set()
    for c, n in zip(codes, lengths):
        assert not any(f"{c:0{n}b}".startswith(s) for s in seen)
        seen.add(f"{c:0{n}b}")


@pytest.mark.parametrize("limits", [{}, {"part_ids": 300, "block_ids": 64}])
def test_files_round_trip(spark, limits):
    from tokenizers import Tokenizer
    library, path = Tokenizer.from_file(VOCABULARY), scratch_path(spark, "test")
    huffman.write_ids(edge_docs(spark), path, VOCABULARY, **limits)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in huffman.read_ids(spark, path).collect())
    want = sorted(((-1 if r[0] is None else r[0]), [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in edge_rows())
    assert sorted((-1 if i is None else i, ids) for _, i, _, ids in got) == want
    assert [-1 if i is None else i for _, i, _, _ in got] == sorted(-1 if r[0] is None else r[0] for r in edge_rows())
    at = 0
    for start, _, n, ids in got:
        assert (start, n) == (at, len(ids))
        at += n
    digest = {(r.start, r.ids_crc32) for r in huffman.read_ids(spark, path, digest=True).collect()}
    assert digest == {(s, zlib.crc32(np.array(ids, "<u4").tobytes())) for s, _, _, ids in got}


def test_empty_table(spark):
    path = scratch_path(spark, "test")
    huffman.write_ids(empty_docs(spark), path, VOCABULARY)
    assert huffman.read_ids(spark, path).collect() == []
