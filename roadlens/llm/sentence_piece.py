"""Operator 2: SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is split before every run of spaces (no piece reaches across such a
place; a vocabulary where one does is not split), and words of more than
``LONG`` characters, as in scripts without spaces, also between any two
characters that no piece has next to each other (so no merge can join them;
only in models that spell unknown characters byte by byte). Words not seen before in the
task are grouped by length, and all words of one length advance together, one
character a step: rolling hashes of the substrings that end there are probed
in the sorted piece keys, and a vectorised maximum over the piece lengths
stores the back pointers. Results are kept per distinct word.

* Unigram models: a path's value is the sum of its pieces' scores.
* BPE models: a sum of scores does not give what their merges give. But a
  segmentation is the merges' own exactly when every two neighbours would stay
  apart if they stood alone, and each prefix has one last piece of that kind.
  So here a path's value is 0 where neighbours stay apart and minus infinity
  where they do not, and the maximum finds that piece. Whether two pieces stay
  apart is read off the merge that made each (vectorised as well).

Characters outside the vocabulary become their UTF-8 bytes' pieces (or the
unknown piece where the model has no byte pieces). Decoding joins the pieces'
bytes and drops the one space that encoding put in front.

Defined results: null and empty texts have no tokens and decode to an empty
text; U+2581 counts as a space, as in the library; null ids and repeated rows
are encoded like any other; further columns pass through :func:`encode_column`.
Only models with the identity normaliser are taken.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from roadlens.llm.common import slices, texts

SPACE = "▁"
SLICE_BYTES = 4 << 20
LONG = 32
KEPT_WORDS = 600_000  # distinct words a worker keeps between batches
ROWS = 1 << 15  # words that advance together at most
MEMO_BITS = 19  # of the table of pairs already compared
_UNSPACED = re.compile(f"[^{SPACE}]{{{LONG},}}")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.iinfo(np.int64).max


def _hash(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes (rows, length + 1) of a matrix of code points."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + codes[:, i] + np.uint64(1)
    return out


def _codes(words: list[str], length: int) -> np.ndarray:
    """Words of one length as a matrix of code points (NULs included)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), length).astype(np.uint64)


@dataclass
class Pieces:
    """A model as arrays; what a task needs, bounded by the vocabulary."""

    pieces: list[str]
    scores: np.ndarray
    usable: np.ndarray  # normal pieces: they may match text
    byte_ids: list[int]  # 256 of them, or none
    unknown: int
    bpe: bool
    prefix: bool
    keys: np.ndarray = field(default=None, repr=False)  # sorted piece hashes
    ids: np.ndarray = field(default=None, repr=False)
    powers: np.ndarray = field(default=None, repr=False)
    rank: np.ndarray = field(default=None, repr=False)  # order of the merges
    left: np.ndarray = field(default=None, repr=False)  # the pieces that a piece was merged from
    right: np.ndarray = field(default=None, repr=False)
    pair_keys: np.ndarray = field(default=None, repr=False)
    pair_rank: np.ndarray = field(default=None, repr=False)

    neighbours: np.ndarray = field(default=None, repr=False)  # sorted pairs of characters that a piece has side by side

    def __post_init__(self):
        self.neighbours = np.array(sorted({ord(a) << 32 | ord(b) for i in np.flatnonzero(self.usable)
                                           for a, b in zip(self.pieces[i], self.pieces[i][1:])}), np.uint64)
        if self.bpe:
            self._merges()
        by_length: dict[int, list[int]] = {}
        for i in np.flatnonzero(self.usable):
            by_length.setdefault(len(self.pieces[i]), []).append(int(i))
        self.longest = max(by_length, default=1)
        keys, ids = [], []
        for length, own in by_length.items():
            keys.append(_hash(_codes([self.pieces[i] for i in own], length))[:, -1])
            ids.append(np.array(own))
        keys, ids = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (ids, np.int64)))
        self.memo_key, self.memo_value = np.full(1 << MEMO_BITS, -1), np.zeros(1 << MEMO_BITS, bool)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces share a hash")
        self.powers = np.full(self.longest + 1, _BASE, np.uint64)
        self.powers[0] = 1
        self.powers = np.cumprod(self.powers, dtype=np.uint64)
        inner = any(SPACE in p.lstrip(SPACE) for p, u in zip(self.pieces, self.usable) if u)
        self.split = re.compile("(?s).+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.raw = [SPACE.join(p.split(SPACE)).replace(SPACE, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([value])

    def _merges(self):
        """For a BPE model, how each piece is made, and which pairs merge."""
        n = len(self.pieces)
        usable = np.flatnonzero(self.usable)
        by_text = {self.pieces[i]: int(i) for i in usable}
        order = sorted(by_text.values(), key=lambda i: (-self.scores[i], i))
        self.rank = np.full(n + 1, _NEVER)
        self.rank[order] = np.arange(len(order))
        self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1)
        pairs = {}
        for text, i in by_text.items():
            for cut in range(1, len(text)):
                a, b = by_text.get(text[:cut]), by_text.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * (n + 1) + b] = int(self.rank[i])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        for text, i in by_text.items():
            if len(text) == 1:
                continue
            parts, made = [by_text.get(c, -1) for c in text], None
            while len(parts) > 1:
                ranked = [(pairs.get(a * (n + 1) + b, _NEVER), at) for at, (a, b) in enumerate(zip(parts, parts[1:]))]
                best, at = min(ranked)
                if best == _NEVER:
                    break
                made = parts[at], parts[at + 1]
                parts[at:at + 2] = [order[best]]
            if parts == [i]:
                self.left[i], self.right[i] = made
            else:
                self.usable[i] = False  # the merges never arrive at this piece

    def parts(self, word: str) -> list[str]:
        """A long word, cut where no piece reaches across."""
        if len(word) <= LONG or not self.byte_ids or not len(self.neighbours):
            return [word]
        codes = _codes([word], len(word))[0]
        pairs = codes[:-1] << np.uint64(32) | codes[1:]
        at = np.minimum(np.searchsorted(self.neighbours, pairs), len(self.neighbours) - 1)
        cuts = (np.flatnonzero(self.neighbours[at] != pairs) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def piece_at(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each substring hash, -1 for none."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.ids[at], -1)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave pieces ``a`` and ``b`` next to each other.

        Walks back through the merges that made the two, latest first: at no
        time may the two symbols that touch have merged earlier than that.
        """
        n = len(self.pieces)
        out, live = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit, limit_is_left = np.full(len(a), _NEVER), np.zeros(len(a), bool)
        while len(live) and len(self.pair_keys):
            key = a * (n + 1) + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joins = np.where(self.pair_keys[at] == key, self.pair_rank[at], _NEVER)
            # equal ranks: the one further left merges first
            bad = (joins < limit) | ((joins == limit) & (joins != _NEVER) & ~limit_is_left)
            out[live[bad]] = False
            made_a = np.where(self.left[a] >= 0, self.rank[a], -1)
            made_b = np.where(self.left[b] >= 0, self.rank[b], -1)
            done = (made_a < 0) & (made_b < 0)
            go = ~bad & ~done
            live, a, b, made_a, made_b = (x[go] for x in (live, a, b, made_a, made_b))
            undo_a = made_a > made_b  # of equal ranks the right one was made last
            limit, limit_is_left = np.where(undo_a, made_a, made_b), undo_a
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def apart_memo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:func:`apart`, with the pairs met before read from a direct-mapped table."""
        key = a * (len(self.pieces) + 1) + b
        slot = (key.astype(np.uint64) * _BASE >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        out = self.memo_value[slot]
        new = np.flatnonzero(self.memo_key[slot] != key)
        if len(new):
            _, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            at = new[first]
            value = self.apart(a[at], b[at])
            out[new] = value[back]
            # of pairs that share a slot any may stay, but key and value together
            own, which = np.unique(slot[at], return_index=True)
            self.memo_key[own], self.memo_value[own] = key[at][which], value[which]
        return out

    def viterbi(self, words: list[str], length: int) -> list[bytes]:
        """The ids (int32, packed) of words of one length."""
        codes = _codes(words, length)
        n, hashes, none = len(words), _hash(codes), len(self.pieces)
        value = np.zeros((n, length + 1))
        last, back = np.full((n, length + 1), -1), np.zeros((n, length + 1), np.int64)
        rows = np.arange(n)
        floor = (float(self.scores[self.usable].min()) if self.usable.any() else 0.0) - 10.0
        for end in range(1, length + 1):
            sizes = range(1, min(end, self.longest) + 1)
            found = np.full((n, len(sizes)), -np.inf)
            piece = np.empty((n, len(sizes)), np.int64)
            for k, size in enumerate(sizes):
                start = end - size
                ids = self.piece_at(hashes[:, end] - hashes[:, start] * self.powers[size])
                piece[:, k] = ids
                hit = np.flatnonzero(ids >= 0)
                if not len(hit):
                    continue
                if not self.bpe:
                    found[hit, k] = value[hit, start] + self.scores[ids[hit]]
                elif start == 0:
                    found[hit, k] = 0.0
                else:
                    before = last[hit, start]
                    found[hit[(before == none) | self.apart_memo(before, ids[hit])], k] = 0.0
            best = found.argmax(axis=1)
            value[:, end], last[:, end], back[:, end] = found[rows, best], piece[rows, best], best + 1
            lost = np.flatnonzero(np.isneginf(value[:, end]))  # unknown character
            value[lost, end] = 0.0 if self.bpe else value[lost, end - 1] + floor
            last[lost, end], back[lost, end] = none, 1
        # all words are walked back together; ids fill each row from the right
        path, at, size = np.zeros((n, length), np.int32), np.full(n, length), np.zeros(n, np.int64)
        while (open_ := np.flatnonzero(at)).size:
            size[open_] += 1
            path[open_, length - size[open_]] = last[open_, at[open_]]
            at[open_] -= back[open_, at[open_]]
        whole, width = path.tobytes(), 4 * length
        out = [whole[end - 4 * k:end] for end, k in zip(range(width, (n + 1) * width, width), size.tolist())]
        for row in np.flatnonzero((last[:, 1:] == none).any(axis=1)).tolist():
            out[row] = self.spelled(words[row], np.frombuffer(out[row], np.int32).tolist())
        return out

    def spelled(self, word: str, path: list[int]) -> bytes:
        """Ids of a path with unknown characters: their byte pieces, or unknown pieces (a run is one)."""
        out, at = [], 0
        for p in path:
            if p != len(self.pieces):
                out.append(p)
                at += len(self.pieces[p])
                continue
            if self.byte_ids:
                out += [self.byte_ids[b] for b in word[at].encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            at += 1
        return np.array(out, np.int32).tobytes()


class Encoder:
    """Encodes batches of texts; keeps the ids of distinct words."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known = pieces, {}

    def _learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, own in by_length.items():
            step = max(1, min(ROWS, (ROWS * 32) // length))
            for at in range(0, len(own), step):
                part = own[at:at + step]
                self.known.update(zip(part, self.pieces.viterbi(part, length)))

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        p = self.pieces
        words = []
        for t in batch:
            t = (SPACE if p.prefix else "") + t.replace(" ", SPACE) if t else ""
            own = p.split.findall(t)
            if _UNSPACED.search(t):
                own = [part for w in own for part in (p.parts(w) if len(w) > LONG else (w,))]
            words.append(own)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = {w for own in words for w in own}
        new.difference_update(self.known)
        self._learn(new)
        find = self.known.__getitem__
        return [np.frombuffer(b"".join(map(find, own)), np.int32) for own in words]

    def decode(self, ids) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become U+FFFD."""
        raw = self.pieces.raw
        data = b"".join([raw[i] for i in ids])
        if self.pieces.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


def load(model: bytes) -> Pieces:
    """The arrays of a serialised SentencePiece model."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(model)
    spec, normal = proto.trainer_spec, proto.normalizer_spec
    if normal.precompiled_charsmap or normal.remove_extra_whitespaces:
        raise ValueError("only models with the identity normaliser are taken")
    if spec.model_type not in (spec.UNIGRAM, spec.BPE) or spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models with spaces in front are taken")
    kind = proto.SentencePiece
    bytes_at = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
    byte_ids = [bytes_at[f"<0x{b:02X}>"] for b in range(256)] if len(bytes_at) == 256 else []
    if any(p.type == kind.USER_DEFINED for p in proto.pieces):
        raise ValueError("models with user-defined pieces are not taken")
    return Pieces([p.piece for p in proto.pieces], np.array([p.score for p in proto.pieces]),
                  np.array([p.type == kind.NORMAL for p in proto.pieces]), byte_ids,
                  next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN),
                  spec.model_type == spec.BPE, normal.add_dummy_prefix)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(pieces: Pieces) -> Encoder:
    """This worker's encoder, kept between tasks for the words it knows."""
    mark = hash((tuple(pieces.pieces), pieces.scores.tobytes(), pieces.bpe))
    if mark not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[mark] = Encoder(pieces)
    return _ENCODERS[mark]


def encode_column(docs: DataFrame, model: bytes, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``token_ids``, ``n_tokens`` and ``round_trip``.

    ``round_trip`` says whether decoding the ids gives the text back (U+2581
    read as a space).
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))  # bounded by the vocabulary

    def run(batches):
        encoder = _encoder(shared.value)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "__text"):
                own = texts(part, "__text").to_pylist()
                ids = encoder.encode(own)
                back = [encoder.decode(i.tolist()) == t.replace(SPACE, " ") for i, t in zip(ids, own)]
                sizes = np.array([len(i) for i in ids], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keep], pa.ListArray.from_arrays(offsets, flat), pa.array(sizes),
                     pa.array(back)], names=[*keep, "token_ids", "n_tokens", "round_trip"])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*rows.select(*keep).schema, T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return rows.mapInArrow(run, schema)
