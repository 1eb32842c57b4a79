"""SentencePiece encoding and decoding by suffix-array matching.

A BPE model with escaped spaces is given as a file. Texts are cut where no piece of the vocabulary holds the two bytes on
both sides, so nothing can be merged across a cut; each distinct segment is encoded once by a worker. The segments of a
batch are put on end and their suffixes sorted as far as the longest piece reaches; every piece is searched by bisection for
the range of suffixes that begin with it, which gives all its occurrences. These edges are sorted by where they end and
relaxed in that order: of the pieces that end at a place exactly one is the last piece of the encoding up to there, the one
that may stand behind the last piece of the encoding up to its start. Two pieces may stand together if no merge across
their border comes before the merges that made them, which a walk down their inner edges decides. The result is the one of
the library's own merging, piece by piece.

Characters outside the vocabulary become byte pieces. Runs of several spaces, whose pieces have equal scores, are merged one
by one. Decoding puts the pieces' bytes on end and drops the space in front.

Both are one pass over the rows without a shuffle. The model's content goes to the tasks, a few bytes for each piece.

Cases: NULL and empty texts have no pieces and decode to an empty text; a text longer than a slice is a slice of its own;
repeated rows and NULL ids are kept; an empty table gives an empty result; extra input columns are ignored. The character
U+2581 stands for a space in the model's alphabet and decodes to one. Ids that do not make valid UTF-8 decode with U+FFFD.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.text import PieceStore, kept_by_worker, ragged, slices, text_bytes

_SLICE = 2_000_000
_LEARN = 100_000  # characters matched at once
_DECODED = 500_000  # pieces put on end at once
_NEVER = np.int64(1) << 40


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model, by id. Ranks grow as scores fall; 0 is a single character."""
    texts: list[str]  # with plain spaces; None for ids that never stand for text
    data: list[bytes]
    ranks: np.ndarray
    left: np.ndarray  # the two pieces whose merge makes the piece
    right: np.ndarray
    bytes_: np.ndarray  # id of each byte
    unknown: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        texts: list[str | None] = [None] * n
        data, by_byte, scores = [b""] * n, np.full(256, model.unk_id(), np.int64), np.zeros(n)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                by_byte[int(piece[3:5], 16)] = i
                data[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                texts[i] = piece.replace("▁", " ")
                data[i], scores[i] = texts[i].encode(), model.get_score(i)
        order = sorted((i for i in range(n) if texts[i] is not None and len(texts[i]) > 1), key=lambda i: -scores[i])
        ranks = np.zeros(n, np.int64)
        rank = 0
        for place, i in enumerate(order):  # equal scores share a rank
            rank = rank if place and scores[i] == scores[order[place - 1]] else place + 1
            ranks[i] = rank
        out = Vocabulary(texts, data, ranks, np.full(n, -1), np.full(n, -1), by_byte, model.unk_id())
        ids = {t: i for i, t in enumerate(texts) if t is not None}
        for i in order:
            made = merged(texts[i], ids, ranks)
            if len(made[0]) == 1 and made[1] is not None:
                out.left[i], out.right[i] = made[1]
            else:
                ranks[i] = -1  # merging never makes it
        return out


def merged(text: str, ids: dict[str, int], ranks: np.ndarray) -> tuple[list[str], tuple[int, int] | None]:
    """The text merged pair by pair, best rank first, then leftmost; and the last pair that was merged."""
    parts: list[str | None] = list(text)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts):
            whole = parts[i] + parts[after[i]]
            if whole in ids:
                heapq.heappush(queue, (int(ranks[ids[whole]]), i, whole))

    for i in range(len(parts) - 1):
        offer(i)
    last = None
    while queue:
        _, i, whole = heapq.heappop(queue)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] + parts[j] != whole:
            continue
        last = ids.get(parts[i], -1), ids.get(parts[j], -1)
        parts[i], parts[j], after[i] = whole, None, after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None], last


class PairRanks:
    """Rank of the piece that two pieces make together, by a table of hashes with a few probes."""

    def __init__(self, ids: dict[str, int], ranks: np.ndarray) -> None:
        pairs = [(ids[t[:c]], ids[t[c:]], ranks[i]) for t, i in ids.items() if ranks[i] > 0 for c in range(1, len(t)) if t[:c] in ids and t[c:] in ids]
        self.bits = max(10, int(np.ceil(np.log2(4 * len(pairs) + 1))))
        keys = np.array([a << 32 | b for a, b, _ in pairs], np.uint64)
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << self.bits, _NEVER)
        left, value, self.probes = np.arange(len(keys)), np.array([r for _, _, r in pairs], np.int64), 0
        while len(left):
            at = self._place(keys[left], self.probes)
            free = self.keys[at] == np.uint64(2**64 - 1)
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = keys[left[put]], value[left[put]]
            left, self.probes = left[~put], self.probes + 1

    def _place(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64) + probe * (probe + 1) // 2) & ((1 << self.bits) - 1)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = self._place(keys, 0)
        out = np.where(self.keys[at] == keys, self.values[at], _NEVER)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != np.uint64(2**64 - 1)))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = self._place(keys[open_], probe)
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != np.uint64(2**64 - 1))]
        return out


class Matcher:
    """Encoder of batches of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.ids = {t: i for i, t in enumerate(vocabulary.texts) if t is not None}
        self.pairs = PairRanks(self.ids, vocabulary.ranks)
        usable = [i for t, i in self.ids.items() if vocabulary.ranks[i] >= 0 and "  " not in t]
        self.piece = np.array(usable, np.int64)
        self.size = np.array([len(vocabulary.texts[i]) for i in usable], np.int64)
        self.longest = int(self.size.max())
        self.letters = np.full((len(usable), self.longest), -1, np.int64)
        for row, i in enumerate(usable):
            self.letters[row, :self.size[row]] = [ord(c) for c in vocabulary.texts[i]]
        joined = np.zeros((256, 256), bool)
        for i in self.ids.values():
            raw = np.frombuffer(vocabulary.data[i], np.uint8)
            joined[raw[:-1], raw[1:]] = True
        joined[:, 0x80:0xC0] = True  # never inside a character
        joined[:, 32] = False
        joined[32, 32] = True
        self.joined = joined.ravel()
        self.store = PieceStore(self._learn)

    def may_stand_together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of two pieces leaves the two."""
        ranks, right, left = self.v.ranks, self.v.right, self.v.left
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a_until, b_until = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(live):
            over = self.pairs.of(a, b)
            # the merge across comes before either piece is taken up by its own side; of equal merges the left one is first
            crossed = (over < a_until) & (over <= b_until) & (over < _NEVER)
            good[live[crossed]] = False
            ra, rb = ranks[a], ranks[b]
            go = ~crossed & ((ra > 0) | (rb > 0))
            live, a, b, a_until, b_until, ra, rb = live[go], a[go], b[go], a_until[go], b_until[go], ra[go], rb[go]
            back = ra > rb  # the later merge is undone; of equal ones the right
            a_until, b_until = np.where(back, ra, a_until), np.where(back, b_until, rb)
            a, b = np.where(back, right[a], a), np.where(back, b, left[b])
        return good

    def edges(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, row of the piece) of every occurrence of every piece, by a suffix array as deep as the longest piece."""
        alphabet, codes = np.unique(letters, return_inverse=True)
        bits = int(len(alphabet)).bit_length()
        step = 62 // bits
        deep = -(-self.longest // step)
        padded = np.concatenate([codes + 1, np.zeros(step * (deep + 1), np.int64)])

        def packed(rows: np.ndarray) -> np.ndarray:
            out = np.zeros(len(rows), np.int64)
            for j in range(step):
                out = out << bits | rows[:, j]
            return out

        word = np.zeros(len(padded) - step, np.int64)
        for j in range(step):
            word = word << bits | padded[j:len(word) + j]
        rank = word[:len(letters)]
        order = np.argsort(rank, kind="stable")
        for level in range(1, deep):  # sort on by the next characters of suffixes that are still equal
            keys = [word[level_ * step:][order] for level_ in range(level + 1)]
            new = np.ones(len(order), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys[:-1]], axis=0)
            group = np.cumsum(new)
            order = order[np.lexsort((keys[-1], group))]
        keys = [word[level * step:][order] for level in range(deep)]

        place = np.searchsorted(alphabet, self.letters)
        known = np.where(self.letters >= 0, alphabet[np.minimum(place, len(alphabet) - 1)] == self.letters, True).all(1)
        rows = np.flatnonzero(known)
        digits = np.where(self.letters[rows] >= 0, place[rows] + 1, 0)
        digits = np.concatenate([digits, np.zeros((len(rows), step * deep - self.longest), np.int64)], 1)
        inside = np.arange(step * deep)[None, :] < self.size[rows][:, None]
        low = [packed(digits[:, d * step:(d + 1) * step]) for d in range(deep)]
        top = np.where(inside, digits, (1 << bits) - 1)
        high = [packed(top[:, d * step:(d + 1) * step]) for d in range(deep)]

        def bisect(want: list[np.ndarray], after: bool) -> np.ndarray:
            a, b = np.zeros(len(rows), np.int64), np.full(len(rows), len(order))
            while (a < b).any():
                open_ = a < b
                mid = np.minimum((a + b) // 2, len(order) - 1)
                less, same = np.zeros(len(rows), bool), np.ones(len(rows), bool)
                for k, w in zip(keys, want):
                    here = k[mid]
                    less |= same & (here < w)
                    same &= here == w
                if after:
                    less |= same
                a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
            return a

        first, end = bisect(low, False), bisect(high, True)
        return order[ragged(first, end - first)], np.repeat(rows, end - first)

    def _relax(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all segments on end, and their numbers. A segment has one space at most, in front."""
        lengths = np.array([len(s) for s in segments], np.int64)
        text = "\n".join(segments)  # a line end is in no piece
        letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        place, row = self.edges(letters)
        owner = np.searchsorted(starts, place, side="right") - 1
        size, piece = self.size[row], self.piece[row]
        # characters that are no piece are edges of their own
        single = np.zeros(len(letters) + 1, bool)
        single[place[size == 1]] = True
        inside = np.ones(len(letters), bool)
        inside[(starts + lengths)[:-1]] = False
        strange = np.flatnonzero(inside & ~single[:-1])
        place, size = np.concatenate([place, strange]), np.concatenate([size, np.ones(len(strange), np.int64)])
        piece = np.concatenate([piece, np.full(len(strange), self.v.unknown)])
        owner = np.concatenate([owner, np.searchsorted(starts, strange, side="right") - 1])
        end = place + size
        step = end - starts[owner]
        order = np.argsort(step, kind="stable")
        place, piece, end, step, owner = place[order], piece[order], end[order], step[order], owner[order]
        last, back = np.full(len(letters) + 1, -1, np.int64), np.zeros(len(letters) + 1, np.int64)
        cuts = np.searchsorted(step, np.arange(1, int(lengths.max(initial=0)) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            before, own = place[a:b], piece[a:b]
            behind = np.where(before == starts[owner[a:b]], -1, last[before])
            good = (behind < 0) | (behind == self.v.unknown) | (own == self.v.unknown)
            ask = np.flatnonzero(~good)
            good[ask] = self.may_stand_together(behind[ask], own[ask])
            last[end[a:b][good]], back[end[a:b][good]] = own[good], before[good]
        # walk all segments back from their ends
        at, live, steps = starts + lengths, np.flatnonzero(lengths), []
        while len(live):
            here = at[live]
            steps.append((live, here, last[here]))
            at[live] = back[here]
            live = live[at[live] > starts[live]]
        if not steps:
            return np.zeros(0, np.int64), np.zeros(len(segments), np.int64)
        seg, pos, ids = (np.concatenate(x) for x in zip(*steps))
        order = np.argsort(pos, kind="stable")
        seg, pos, ids = seg[order], pos[order], ids[order]
        count = np.ones(len(ids), np.int64)
        spelled = np.flatnonzero(ids == self.v.unknown)
        spell = [self._spelled(chr(letters[p - 1])) for p in pos[spelled]]
        count[spelled] = [len(s) for s in spell]
        out = np.repeat(ids, count)
        if spell:
            out[ragged((np.cumsum(count) - count)[spelled], count[spelled])] = np.concatenate(spell)
        return out, np.bincount(seg, weights=count, minlength=len(segments)).astype(np.int64)

    def _spelled(self, char: str) -> np.ndarray:
        return self.v.bytes_[np.frombuffer(char.encode(), np.uint8)]

    def _merged(self, segment: str) -> np.ndarray:
        parts = merged(segment, self.ids, self.v.ranks)[0]
        return np.concatenate([np.array([self.ids[p]]) if p in self.ids else self._spelled(p) for p in parts])

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pieces.to_pylist()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        chunk, size, spaced = [], 0, {}
        for n, s in enumerate(texts):
            if "  " in s:
                spaced[n] = self._merged(s)
                s = ""
            chunk.append(s)
            size += len(s) + 1
            if size >= _LEARN:
                found.append(self._relax(chunk))
                chunk, size = [], 0
        if chunk:
            found.append(self._relax(chunk))
        ids, counts = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        if spaced:
            each = np.split(ids, np.cumsum(counts)[:-1])
            for n, own in spaced.items():
                each[n], counts[n] = own, len(own)
            ids = np.concatenate(each)
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and offsets of the texts."""
        texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.string()), "▁", " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joined[data[:-1].astype(np.int32) * 256 + data[1:]]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        bounds = np.append(np.flatnonzero(cut), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        ids, ends = self.store.ids_of(pieces)
        return ids, ends[np.searchsorted(bounds, offsets)]


def encode_pieces(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and pieces, array of int."""
    kind = df.schema[id_col].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(_packed(vocabulary))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = kept_by_worker("pieces", sent.value, lambda raw: Matcher(_unpacked(raw)))
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                ids, offsets = matcher.encode(part.column(1))
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["id", "pieces"])

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(task, f"id {kind}, pieces array<int>").withColumnRenamed("id", id_col)


def decode_pieces(df: DataFrame, vocabulary: Vocabulary, pieces_col: str = "pieces", text_col: str = "text") -> DataFrame:
    """The input with ``text_col`` added: the text of the pieces; a NULL array is an empty text."""
    if text_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {text_col} already")
    place, names = df.columns.index(pieces_col), df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    lengths = np.array([len(b) for b in vocabulary.data], np.int64)
    raw = np.frombuffer(b"".join(vocabulary.data), np.uint8)

    def joined(column: pa.Array) -> pa.Array:
        starts = np.cumsum(lengths) - lengths
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
        ids = column.flatten().to_numpy(zero_copy_only=False)
        size = lengths[ids]
        data = raw[ragged(starts[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(sizes)])]
        lead = np.zeros(len(sizes), np.int64)
        filled = np.diff(ends) > 0
        lead[filled] = data[ends[:-1][filled]] == 32
        keep = np.ones(len(data), bool)
        keep[ends[:-1][lead == 1]] = False
        data, ends = data[keep], ends - np.concatenate([[0], np.cumsum(lead)])
        texts = pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            whole = data.tobytes()
            texts = pa.array([whole[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())
        return texts

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(place)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _DECODED, side="right")))
                part = batch.slice(at, to - at)
                yield pa.record_batch([*part.columns, joined(part.column(place))], [*batch.schema.names, "text"])
                at = to

    from pyspark.sql.types import StringType, StructType
    schema = StructType(list(plain.schema.fields)).add("text", StringType())
    return plain.mapInArrow(task, schema).toDF(*names, text_col)


def _packed(vocabulary: Vocabulary) -> bytes:
    import pickle
    return pickle.dumps(vocabulary.__dict__)


def _unpacked(raw: bytes) -> Vocabulary:
    import pickle
    return Vocabulary(**pickle.loads(raw))


def load(path: str) -> Vocabulary:
    if not Path(path).exists():
        raise FileNotFoundError(path)
    return Vocabulary.load(path)
