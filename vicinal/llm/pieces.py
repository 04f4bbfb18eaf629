"""SentencePiece encoding and decoding with batched numpy Viterbi passes.

Distinct words (a run of spaces and what follows) are encoded once a batch. Words of equal length advance together, one
position at a time: rolling hashes of all their substrings are looked up among the sorted hashes of the pieces, and at every position
the best piece ending there is stored as a back-pointer, for all words at once.

What is best depends on the model. A unigram model maximises the sum of scores. A BPE model is not a maximum of any sum, yet its
result has the same form: the pieces of a prefix are the pieces of a shorter prefix and one more piece, and exactly one candidate
is compatible with the piece before it (merging both texts alone would give the same two pieces). So the maximum is taken
over the compatible candidates, and the result equals the merge rules'. Compatibility is decided for arrays of pairs by undoing merges, latest
first, and looking for a merge across the border that would have come earlier."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
TOGETHER = 8192        # words that advance together, at most
EXACT = 32             # longest words grouped by exact length; longer ones are padded to a common length
SIEVE = np.uint64(44)  # a table by the upper bits of a hash stands before each search in sorted keys
LONG = 48              # characters from which a word is cut at places that no piece crosses
REMEMBERED = 250_000   # distinct words that a task remembers
UNIGRAM, BPE = 1, 2


@dataclass
class Pieces:
    """A vocabulary. ``ids`` above its size stand for single characters that have no piece: the last one for any unknown."""
    texts: list[str]
    scores: np.ndarray
    kinds: list[str]              # normal, byte, control, unknown
    model: int
    prefix: bool = True           # a space is put before the text
    fallback: bool = True         # unknown characters become byte pieces

    def prepare(self) -> "Tables":
        return Tables(self)


def fields(data: bytes):
    """(number, value) of a protocol buffer message's fields; nested messages stay bytes."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at:at + size]
            at += size


def load(path: str = MODEL) -> Pieces:
    """Read a model file (on the driver; tasks get the vocabulary with the plan)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    parts = {}
    for number, value in fields(sp.serialized_model_proto()):
        if number in (2, 3):
            parts[number] = dict(fields(value))
    trainer, normal = parts.get(2, {}), parts.get(3, {})
    if normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
        raise ValueError("only models without text normalisation are supported")
    n = sp.get_piece_size()
    kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "normal" for i in range(n)]
    return Pieces([sp.id_to_piece(i) for i in range(n)], np.array([sp.get_score(i) for i in range(n)], np.float32), kinds,
                  trainer.get(3, UNIGRAM), bool(normal.get(3, 1)), bool(trainer.get(35, 0)))


def merged(text: str, rank: dict[str, int]):
    """The merge rules, plainly: pieces of a text, and the last merge's two halves."""
    parts, halves = list(text), None
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: (rank.get(parts[i] + parts[i + 1], 1 << 40), i))
        if parts[best] + parts[best + 1] not in rank:
            break
        halves = (parts[best], parts[best + 1])
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts, halves


def hashed(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Tables:
    """Arrays that the passes use; bounded by the vocabulary."""

    def __init__(self, p: Pieces):
        self.pieces, n = p, len(p.texts)
        live = [i for i in range(n) if p.kinds[i] == "normal" and p.texts[i]]
        self.longest = max((len(p.texts[i]) for i in live), default=1)
        ids = {p.texts[i]: i for i in live}
        leaves = sorted({c for i in live for c in p.texts[i]} - set(ids))
        ids |= {c: n + k for k, c in enumerate(leaves)}
        self.unknown = n + len(leaves)
        size = self.unknown + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int32), np.zeros(size, np.int32)
        usable = set(ids)
        if p.model == BPE:
            order = sorted((i for i in live if len(p.texts[i]) > 1), key=lambda i: (-p.scores[i], i))
            rank = {p.texts[i]: r for r, i in enumerate(order)}
            pairs = {}
            for text, r in rank.items():
                i = ids[text]
                self.rank[i] = r
                for k in range(1, len(text)):
                    if text[:k] in ids and text[k:] in ids:
                        pairs[ids[text[:k]] * size + ids[text[k:]]] = r
                parts, halves = merged(text, rank)
                if len(parts) > 1:
                    usable.discard(text)
                    continue
                self.left[i], self.right[i] = ids[halves[0]], ids[halves[1]]
                if max(self.rank[self.left[i]], self.rank[self.right[i]]) > r:
                    # A piece that is ready before its parts: undoing by rank would be wrong.
                    raise ValueError(f"piece {text!r} ranks before its parts")
            self.pairs = np.array(sorted(pairs), np.int64)
            self.pair_rank = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
            self.pair_sieve = np.zeros(1 << (64 - int(SIEVE)), bool)
            self.pair_sieve[(self.pairs.view(np.uint64) * BASE) >> SIEVE] = True
        found = sorted((hashed(t), len(t), ids[t]) for t in usable)
        self.keys = np.array([f[0] for f in found], np.uint64)
        self.sieve = np.zeros(1 << (64 - int(SIEVE)), bool)
        self.sieve[self.keys >> SIEVE] = True
        self.lengths = np.array([f[1] for f in found], np.int32)
        self.at = np.array([f[2] for f in found], np.int32)
        self.scores = np.full(size, (p.scores[live].min() if live else 0.0) - 10, np.float32)
        self.scores[:n] = p.scores
        after = {b for i in live for b in p.texts[i][1:]}
        # Words start at spaces if no piece has a space behind anything else.
        whole = any(SPACE in p.texts[i].lstrip(SPACE) for i in live)
        alone = "" if "\n" in after or any(len(p.texts[i]) > 1 and p.texts[i][0] == "\n" for i in live) else "\n"
        self.words = re.compile(r"(?s).+" if whole else f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|{alone}" if alone else ""))
        self.bytes = {int(p.texts[i][3:5], 16): i for i in range(n) if p.kinds[i] == "byte"}
        self.unk = p.kinds.index("unknown") if "unknown" in p.kinds else -1

        # Pairs of characters that stand together in some piece, and characters that are pieces.
        self.joined = np.array(sorted({ord(a) << 21 | ord(b) for i in live for a, b in zip(p.texts[i], p.texts[i][1:])}), np.int64)
        self.single = np.array(sorted(ord(p.texts[i]) for i in live if len(p.texts[i]) == 1), np.int64)

    # -- one group of words

    def substrings(self, chars: np.ndarray) -> np.ndarray:
        """(length - 1, word, start) -> piece that spells this substring, or -1."""
        k, n = chars.shape
        most = min(n, self.longest)
        out = np.full((most, k, n), -1, np.int32)
        value = chars.astype(np.uint64) + np.uint64(1)
        h = np.zeros((k, n), np.uint64)
        for size in range(1, most + 1):
            h = h[:, : n - size + 1] * BASE + value[:, size - 1:]
            word, start = np.nonzero(self.sieve[h >> SIEVE])      # most substrings are no piece
            some = h[word, start]
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            hit = (self.keys[at] == some) & (self.lengths[at] == size)
            out[size - 1, word[hit], start[hit]] = self.at[at[hit]]
        single = out[0]
        single[single < 0] = self.unknown
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of neighbours is what the merge rules leave of the two texts together."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        limit = np.full(len(a), 1 << 40, np.int64)
        a, b = a.astype(np.int64), b.astype(np.int64)
        size = self.unknown + 1
        while len(live):
            key = a * size + b
            some = np.flatnonzero(self.pair_sieve[(key.view(np.uint64) * BASE) >> SIEVE])
            at = np.minimum(np.searchsorted(self.pairs, key[some]), len(self.pairs) - 1)
            bad = np.zeros(len(key), bool)
            bad[some] = (self.pairs[at] == key[some]) & (self.pair_rank[at] < limit[some])
            ok[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return ok

    def back_pointers(self, chars: np.ndarray) -> np.ndarray:
        """(word, end) -> the piece that ends there in the best division of the text so far."""
        k, n = chars.shape
        spell = self.substrings(chars)
        last = np.full((k, n + 1), -1, np.int32)
        if self.pieces.model != BPE:
            best = np.full((k, n + 1), -np.inf, np.float32)
            best[:, 0] = 0
            for end in range(1, n + 1):
                size = np.arange(min(end, self.longest), 0, -1)
                piece = spell[size - 1, :, end - size]
                value = np.where(piece >= 0, best[:, end - size].T + self.scores[piece], np.float32(-np.inf))
                pick = value.argmax(axis=0)
                row = np.arange(k)
                best[:, end], last[:, end] = value[pick, row], piece[pick, row]
            return last
        for end in range(1, n + 1):
            size = np.arange(1, min(end, self.longest) + 1)
            piece = spell[size - 1, :, end - size]
            which, row = np.nonzero(piece >= 0)
            piece, start = piece[which, row], end - size[which]
            ok = start == 0
            rest = np.flatnonzero(~ok)
            ok[rest] = self.compatible(last[row[rest], start[rest]], piece[rest])
            last[row[ok], end] = piece[ok]
        return last

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids one after another) for distinct words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        group = np.where(sizes <= EXACT, sizes, EXACT << np.ceil(np.log2(np.maximum(sizes, 1) / EXACT)).clip(0).astype(np.int64))
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        found: list = [None] * len(words)
        for part in np.split(order, cuts):
            if not len(part):
                continue
            wide = int(group[part[0]])
            step = max(1, min(TOGETHER, (TOGETHER * 16) // wide))
            for at in range(0, len(part), step):
                chosen = part[at:at + step]
                self._group([words[i] for i in chosen], sizes[chosen], wide, chosen, found)
        counts = np.fromiter(map(len, found), np.int64, len(words))
        return counts, np.concatenate(found) if found else np.empty(0, np.int32)

    def _group(self, words, sizes, wide, chosen, found):
        text = "".join(w.ljust(wide, "\0") for w in words)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), wide)
        last = self.back_pointers(chars)
        span = np.ones(self.unknown + 1, np.int64)
        span[self.at] = self.lengths
        rows, end = np.arange(len(words)), sizes.copy()
        steps = []
        while len(rows):
            piece = last[rows, end]
            steps.append((rows, piece))
            end = end - span[piece]
            more = end > 0
            rows, end = rows[more], end[more]
        row = np.concatenate([s[0] for s in steps])[::-1]
        piece = np.concatenate([s[1] for s in steps])[::-1]
        order = np.argsort(row, kind="stable")
        row, piece = row[order], piece[order]
        starts = np.searchsorted(row, np.arange(len(words) + 1))
        plain = len(self.pieces.texts)
        odd = set(row[piece >= plain].tolist())
        for r in range(len(words)):
            ids = piece[starts[r]:starts[r + 1]]
            found[chosen[r]] = ids if r not in odd else self._spelled(words[r], ids, span)

    def _spelled(self, word: str, ids: np.ndarray, span: np.ndarray) -> np.ndarray:
        """Characters without a piece as byte pieces, or as one unknown piece for a run of them."""
        out, at = [], 0
        for i in ids.tolist():
            if i < len(self.pieces.texts):
                out.append(i)
            elif self.pieces.fallback:
                out.extend(self.bytes[b] for b in word[at].encode("utf-8", "surrogatepass"))
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
            at += int(span[i])
        return np.array(out, np.int32)

    # -- texts

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(" ", SPACE)
        words = self.words.findall(SPACE + text if self.pieces.prefix else text)
        return words if max(map(len, words)) <= LONG else [part for word in words for part in (self.parts(word) if len(word) > LONG else (word,))]

    def parts(self, word: str) -> list[str]:
        """A long word, such as a text without spaces, cut where no piece spells the two characters together: no division and no merge
        crosses such a place. Runs of characters that become one unknown piece stay whole."""
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        free = ~_within(chars[:-1] << 21 | chars[1:], self.joined)
        if not self.pieces.fallback:
            known = _within(chars, self.single)
            free &= known[:-1] | known[1:]
        edges = [0, *(np.flatnonzero(free) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:])]


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)


class Encoder:
    """Encodes batches of texts; remembers words between them, within a bound."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.counts, self.ids = np.empty(0, np.int64), np.empty(0, np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        if len(self.known) > REMEMBERED:
            self.clear()
        known = self.known
        before = len(known)
        rows = []
        for t in texts:
            words = self.tables.split(t)
            rows.append(np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words)))
        if len(known) > before:
            new = list(known)[before:]
            counts, ids = self.tables.encode_words(new)
            self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
        starts = np.cumsum(self.counts) - self.counts
        word = np.concatenate(rows) if rows else np.empty(0, np.int64)
        n = self.counts[word]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(starts[word] - (ends - n), n)
        sizes = np.array([len(r) for r in rows], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return np.concatenate([[0], ends])[edges], self.ids[at]


def encode(docs: DataFrame, pieces: Pieces, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, decoded: str | None = None,
           room: int = 3 << 20) -> DataFrame:
    """(columns ``keep``, by default the id; ids): the piece numbers of every whole text, empty for null and empty
    texts. With ``decoded``, a column of that name holds what they decode to, as ``decode`` has it, in the same pass. Texts go through a task in slices of about ``room`` characters, so its memory does not depend on how many it gets."""
    keep = [id] if keep is None else keep
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("__text"))
    names, tables = [*keep, "ids", *([decoded] if decoded else [])], pieces.prepare()

    def run(batches):
        encoder, decoder = Encoder(tables), Decoder(pieces)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + room, side="right")))
                part = [(t.as_py() or b"").decode("utf-8", "replace") for t in texts.slice(at, to - at)]
                offsets, ids = encoder.encode(part)
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                back = [pa.array([decoder.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())] if decoded else []
                yield pa.record_batch([*(c.slice(at, to - at) for c in batch.columns[:-1]), listed, *back], names)
                at = to

    schema = frame.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))
    return frame.mapInArrow(run, schema.add(decoded, "string") if decoded else schema)


def decode(encoded: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the column ``text`` made from ``ids``: null for null, and for a text without U+2581 exactly what was encoded (that
    character stands for a space in the vocabulary)."""
    names = [*encoded.columns, text]
    at = encoded.columns.index(ids)

    def run(batches):
        tables = Decoder(pieces)
        for batch in batches:
            column = batch.column(at)
            out = [tables.decode(v.values.to_numpy(zero_copy_only=False)) if v.is_valid else None for v in column]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.string())], names)

    schema = encoded.select("*").schema.add(text, "string")
    return encoded.mapInArrow(run, schema)


class Decoder:
    """Decoding by one lookup a piece: every piece's UTF-8 bytes, joined. Control pieces say nothing; bytes that are no
    UTF-8 become U+FFFD."""

    def __init__(self, p: Pieces):
        self.prefix = p.prefix
        self.spelled = [bytes([int(t[3:5], 16)]) if k == "byte" else t.replace(SPACE, " ").encode() if k == "normal" else
                        " ⁇ ".encode() if k == "unknown" else b"" for t, k in zip(p.texts, p.kinds)]

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.spelled
        out = b"".join([spelled[i] for i in ids.tolist()])
        return (out[1:] if self.prefix and out[:1] == b" " else out).decode("utf-8", "replace")
