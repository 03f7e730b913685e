"""Unigram segmentation of texts: the sequence of pieces with the greatest sum of scores, by Viterbi over a double-array trie.

Spaces become the marker U+2581 and a text begins with one. Pieces and their scores come from a model file and are taken as they are. They
are log probabilities where the model was trained as a unigram one; a model of merges holds negated merge ranks, whose greatest sum
is no likelihood and differs from that model's own merging. A character that is no piece costs ten less than the least score and is written as its UTF-8 bytes. Scores are added in double precision; of equally good
segmentations the one with the longer last piece wins, at every place.

A marker after another character begins a new stretch that no piece crosses (checked when the model is read), so a text is segmented
stretch by stretch and each distinct stretch once; a literal U+2581 in a text is written as bytes, so decoding restores it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ship

ship(__name__)

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Bounds of work at once: characters of text, cells of a group of stretches, bytes of a stretch that still joins a group.
CHUNK_CHARS, GROUP_CELLS, LONG = 1 << 19, 1 << 20, 96


@dataclass
class Trie:
    """Double array: the child of node n by byte c is ``base[n] + c + 1`` if ``check`` there is n; ``value`` is a piece id or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> Trie:
        root: dict = {}
        for key, v in keys.items():
            node = root
            for c in key:
                node = node.setdefault(c, {})
            node[-1] = v
        size = 1024
        used, base, check, value = bytearray(size), [0] * size, [-1] * size, [-1] * size
        used[0] = 1
        first, waiting = 1, [(root, 0)]
        for node, at in waiting:  # grows while it is read: breadth first
            value[at] = node.get(-1, -1)
            codes = sorted(c + 1 for c in node if c >= 0)
            if not codes:
                continue
            pos, tries = first, 0
            while True:
                if pos + 260 > size:
                    used += bytes(size)
                    base += [0] * size
                    check += [-1] * size
                    value += [-1] * size
                    size *= 2
                pos = used.find(0, pos)
                start = pos - codes[0]
                if start >= 0 and not any(used[start + c] for c in codes):
                    break
                pos, tries = pos + 1, tries + 1
            # Leave behind stretches where searching has become long.
            first = pos if tries > 200 else used.find(0, first)
            base[at] = start
            for c in codes:
                used[start + c] = 1
                check[start + c] = at
                waiting.append((node[c - 1], start + c))
        end = max(i for i in range(size) if used[i]) + 258
        return cls(*(np.array(x[:end] + [fill] * (end - len(x[:end])), np.int32) for x, fill in ((base, 0), (check, -1), (value, -1))))


@dataclass
class Model:
    """What a model file holds: scores by piece id, the trie of normal pieces, ids of the byte pieces, text of each id."""

    scores: np.ndarray
    trie: Trie
    byte_ids: list[int]
    unknown: int
    texts: list[bytes]
    stretch: str

    @classmethod
    def load(cls, path: str) -> Model:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = {i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        byte_of = {i: int(pieces[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        ids = {b: i for i, b in byte_of.items()}
        texts = [bytes([byte_of[i]]) if i in byte_of else pieces[i].replace(MARKER, " ").encode() if i in normal else b"" for i in range(n)]
        scores = np.array([sp.get_score(i) if i in normal else 0.0 for i in range(n)])
        crossing = any(re.search(f"[^{MARKER}]{MARKER}", pieces[i]) for i in normal)
        lines = any("\n" in pieces[i] for i in normal)
        inner = f"[^{MARKER}]" if lines else f"[^{MARKER}\n]"
        stretch = "(?s:.+)" if crossing else f"{MARKER}+{inner}*|{inner}+" + ("" if lines else "|\n")
        trie = Trie.build({pieces[i].encode(): i for i in normal})
        return cls(scores, trie, [ids[b] for b in range(256)] if len(ids) == 256 else [], sp.unk_id(), texts, stretch)


class Segmenter(dict):
    """Ids of texts as bytes of 32-bit numbers. Stretches are kept up to ``limit``, then forgotten, which changes no result."""

    def __init__(self, model: Model, limit: int = 150_000):
        super().__init__()
        self.limit = limit
        self.model = model
        self.base, self.check, self.value = (x.tolist() for x in (model.trie.base, model.trie.check, model.trie.value))
        self.scores = model.scores.tolist()
        kept = [s for s, t in zip(self.scores, model.texts, strict=True) if t]
        self.unknown_score = min(kept, default=0.0) - UNKNOWN_PENALTY
        self.score_array = model.scores
        self.cut = re.compile(model.stretch)
        self.marker = np.array(self.spell(MARKER.encode()), "<i4").tobytes()
        self[None] = self.marker

    def spell(self, raw: bytes) -> list[int]:
        return [self.model.byte_ids[b] for b in raw] if self.model.byte_ids else [self.model.unknown]

    def segment(self, raw: bytes) -> list[int]:
        """Viterbi over one stretch of UTF-8."""
        n, base, check, value, scores = len(raw), self.base, self.check, self.value, self.scores
        best, back, piece = [None] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        at = 0
        while at < n:
            lead = raw[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, node, single = best[at], 0, False
            for end in range(at, n):
                child = base[node] + raw[end] + 1
                if check[child] != node:
                    break
                node = child
                v = value[node]
                if v >= 0:
                    s = here + scores[v]
                    if best[end + 1] is None or s > best[end + 1]:
                        best[end + 1], back[end + 1], piece[end + 1] = s, at, v
                    single = single or end + 1 - at == width
            if not single:
                s, end = here + self.unknown_score, at + width
                if best[end] is None or s > best[end]:
                    best[end], back[end], piece[end] = s, at, -1
            at += width
        out: list[list[int]] = []
        at = n
        while at:
            out.append([piece[at]] if piece[at] >= 0 else self.spell(raw[back[at] : at]))
            at = back[at]
        return [i for x in reversed(out) for i in x]

    def segment_all(self, stretches: list[str]) -> list[bytes]:
        """:meth:`segment` of many stretches at once, in groups of similar length and at most GROUP_CELLS bytes of padding and text."""
        raws = [s.encode() for s in stretches]
        order = sorted(range(len(raws)), key=lambda i: len(raws[i]))
        out: list[bytes] = [b""] * len(raws)
        at = 0
        while at < len(order):
            end = at
            while end < len(order) and (end - at + 1) * len(raws[order[end]]) <= GROUP_CELLS and len(raws[order[end]]) <= LONG:
                end += 1
            if end == at:  # a long stretch is worked on by itself
                out[order[at]] = np.array(self.segment(raws[order[at]]), "<i4").tobytes()
                at += 1
                continue
            for i, ids in zip(order[at:end], self._segment_group([raws[i] for i in order[at:end]]), strict=True):
                out[i] = ids
            at = end
        return out

    def _segment_group(self, raws: list[bytes]) -> list[bytes]:
        """Viterbi over stretches sorted by length, all at one place at a time, in the order of :meth:`segment`."""
        trie, m = self.model.trie, len(raws)
        sizes = np.array([len(r) for r in raws])
        width = int(sizes[-1])
        text = np.zeros((width, m), np.int32)  # one column for each stretch
        text[np.arange(width)[:, None] < sizes] = -1
        joined = np.frombuffer(b"".join(raws), np.uint8).astype(np.int32)
        text.T[text.T == -1] = joined
        starts = (text & 0xC0) != 0x80
        best = np.full((width + 1, m), -np.inf)
        best[0] = 0.0
        back, piece = np.zeros((width + 1, m), np.int32), np.full((width + 1, m), -1, np.int32)
        for at in range(width):
            first = int(np.searchsorted(sizes, at, "right"))  # stretches that reach beyond this place
            rows = first + np.flatnonzero(starts[at, first:])
            if not len(rows):
                continue
            lead = text[at, rows]
            char = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            here = best[at, rows]
            single = np.zeros(len(rows), bool)
            live, node = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for end in range(at, width):
                inside = sizes[rows[live]] > end
                live, node = live[inside], node[inside]
                child = trie.base[node] + text[end, rows[live]] + 1
                found = trie.check[child] == node
                live, node = live[found], child[found]
                if not len(live):
                    break
                v = trie.value[node]
                has = v >= 0
                own = live[has]
                if len(own):
                    v, to = v[has], rows[own]
                    s = here[own] + self.score_array[v]
                    better = s > best[end + 1, to]
                    to = to[better]
                    best[end + 1, to], back[end + 1, to], piece[end + 1, to] = s[better], at, v[better]
                    single[own] |= char[own] == end + 1 - at
            rest = ~single
            if rest.any():
                to, end, s = rows[rest], at + char[rest], here[rest] + self.unknown_score
                better = s > best[end, to]
                to, end = to[better], end[better]
                best[end, to], back[end, to], piece[end, to] = s[better], at, -1
        # The ways back, all stretches a step at a time; then the pieces in order of their places.
        live, at = np.arange(m), sizes.copy()
        steps = []
        while len(live):
            before = back[at, live]
            steps.append((live, before, at, piece[at, live]))
            live, at = live[before > 0], before[before > 0]
        owner, begin, end, ids = (np.concatenate(c) for c in zip(*steps, strict=True))
        order = np.lexsort((begin, owner))
        owner, begin, end, ids = owner[order], begin[order], end[order], ids[order]
        spelled = (ids < 0) & bool(self.model.byte_ids)
        n = np.where(spelled, end - begin, 1)
        each = np.repeat(np.arange(len(ids)), n)
        byte = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        flat = np.where(ids[each] < 0, self.model.unknown, ids[each])
        by_byte = spelled[each]
        if by_byte.any():
            flat[by_byte] = np.array(self.model.byte_ids)[text[begin[each] + byte, owner[each]][by_byte]]
        ends = 4 * np.cumsum(np.bincount(owner, n, m).astype(np.int64))
        raw = flat.astype("<i4").tobytes()
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def stretches(self, text: str) -> list[str | None]:
        """The stretches of a text in order; None for a literal marker, which is spelled and which nothing crosses."""
        out: list[str | None] = []
        begin = MARKER
        for i, part in enumerate(text.split(MARKER)):
            if i:
                out += [begin, None] if begin else [None]
                begin = ""
            if part:
                out += self.cut.findall(begin + part.replace(" ", MARKER))
                begin = ""
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts as bytes of 32-bit numbers; null and empty have none. New stretches of some texts are segmented together."""
        out, at = [], 0
        while at < len(texts):
            cut, size = [], 0
            while at < len(texts) and (not cut or size + len(texts[at] or "") <= CHUNK_CHARS):
                cut.append(self.stretches(texts[at]) if texts[at] else [])
                size += len(texts[at] or "")
                at += 1
            if len(self) >= self.limit:
                self.clear()
                self[None] = self.marker
            new = list({s for c in cut for s in c if s not in self})
            own = dict(zip(new, self.segment_all(new), strict=True))
            self.update((s, ids) for s, ids in own.items() if len(s) < 200)
            out += [b"".join([self.get(s) or own[s] for s in c]) for c in cut]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def slices(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, a row or up to ``most`` of ``sizes`` at a time; an empty batch has no slices."""
    ends, begin = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ids of every row; null and empty texts have no ids. Other columns are ignored; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(model)
        for batch in batches:
            for rows in slices(batch, pc.coalesce(pc.binary_length(batch.column(1)), 0), CHUNK_CHARS):
                raw = segmenter.encode_all(rows.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(raw), "<i4")))
                del raw
                yield pa.RecordBatch.from_arrays([rows.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with ``text`` decoded from ``ids``: byte pieces are joined to UTF-8 (what is none becomes U+FFFD), markers become
    spaces, the leading one goes. Null ids give a null text; a column ``text`` is replaced, all others stay.
    """
    own = [c for c in rows.columns if c != "text"]
    at = own.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.texts
        for batch in batches:
            for rows in slices(batch, pc.coalesce(pc.list_value_length(batch.column(at)), 0), CHUNK_CHARS // 4):
                column = rows.column(at)
                flat = column.flatten().to_numpy(zero_copy_only=False)
                texts, i = [], 0
                for n in column.value_lengths().to_pylist():
                    if n is None:
                        texts.append(None)
                        continue
                    texts.append(b"".join([table[x] for x in flat[i : i + n].tolist()]).decode("utf-8", "replace").removeprefix(" "))
                    i += n
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*own, "text"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in own]
    return rows.select(*own).mapInArrow(run, ", ".join([*kinds, "text string"]))
