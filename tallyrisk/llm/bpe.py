"""Byte-level BPE encoding and decoding with a segment tree over pair ranks (operator 8).

A piece starts as its bytes. A segment tree holds, for each position, the merge rank of the pair
that begins there; its root is the lowest rank, leftmost first. Each step merges that pair,
relinks the neighbours and updates at most three leaves, so a piece of n bytes costs
O(n log n), however long it is. Encoded pieces are remembered per task up to a fixed number.

Defined results: null and empty texts give no tokens and the empty string; special tokens in a
text become their ids, as the tokenizer file has them; repeated rows are encoded alike; an empty
table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyrisk.llm.common import append_columns, project_columns

# Fixed value: the published splitting pattern of byte-level BPE vocabularies.
PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000     # pieces kept per task, and bytes of them; all are dropped when the store would outgrow
REMEMBERED_BYTES = 96 << 20   # either (what one chunk of texts adds is bounded by the chunk)
NONE = 1 << 62           # leaf without a pair
_AT = 1 << 32            # a leaf is rank * 2**32 + position
SIDE_BY_SIDE = 64        # longer pieces (in bytes) are merged one by one
BATCH = 1 << 20          # bytes of pieces merged side by side


def byte_symbols() -> list[str]:
    """Printable stand-in character of each byte: printable Latin-1 stands for itself, the other
    bytes take the code points from 256 on, in byte order."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class PairTree:
    """Minimum of (rank, position) over a fixed number of leaves, with point updates."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(len(values) - 1, 0).bit_length()
        none = NONE
        self.tree = tree = [none] * self.size + values + [none] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a <= b else b

    def set(self, at: int, value: int) -> None:
        tree, i = self.tree, self.size + at
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a <= b else b
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1




class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.first = [vocab[s] for s in symbols]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        back = {s: b for b, s in enumerate(symbols)}
        self.bytes = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes.update({i: s.encode() for s, i in self.special.items()})
        self.split = regex.compile(PATTERN).findall
        self.cut = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
                    .split if self.special else None)
        keys = np.array([(a << 20) | b for a, b in self.pairs], np.int64)
        ranks = np.array([r for r, _ in self.pairs.values()], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.token_of_rank = np.zeros(int(ranks.max(initial=0)) + 1, np.int64)
        self.token_of_rank[ranks] = [t for _, t in self.pairs.values()]
        self.fixed = {s: (1, str(i), self.bytes[i]) for s, i in self.special.items()}
        self.known: dict[str, tuple[int, str, bytes]] = dict(self.fixed)
        self.held = 0            # bytes of the pieces in the store

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        ids = [self.first[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        pairs = self.pairs
        none = (NONE >> 32, 0)
        tree = PairTree([(pairs.get(p, none)[0] << 32) | i for i, p in enumerate(zip(ids, ids[1:]))])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        top, limit = tree.tree, NONE >> 32 << 32
        while top[1] < limit:
            i = top[1] & (_AT - 1)
            j = after[i]
            ids[i] = pairs[ids[i], ids[j]][1]
            k = after[i] = after[j]
            ids[j] = -1
            if j < n - 1:
                tree.set(j, NONE)
            if k < n:
                before[k] = i
                tree.set(i, (pairs.get((ids[i], ids[k]), none)[0] << 32) | i)
            else:
                tree.set(i, NONE)
            h = before[i]
            if h >= 0:
                tree.set(h, (pairs.get((ids[h], ids[i]), none)[0] << 32) | h)
        return [x for x in ids if x >= 0]

    def merge_many(self, pieces: list[bytes], size: int) -> list[list[int]]:
        """``merge`` for pieces of at most ``size`` (a power of two) bytes, their trees side by side.

        Row r of ``tree`` is the segment tree of piece r; each round takes the root of every
        unfinished tree, merges that pair and updates the three leaves and their ancestors.
        """
        n, count = size, len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, count)
        data = np.frombuffer(b"".join(p.ljust(n, b"\0") for p in pieces), np.uint8).reshape(count, n)
        ids = np.asarray(self.first, np.int64)[data]
        column = np.arange(n)
        ids[column >= length[:, None]] = -1
        after = np.tile(column + 1, (count, 1))
        before = np.tile(np.arange(-1, n), (count, 1))       # one spare column past the end
        tree = np.full((count, 2 * n), NONE, np.int64)
        tree[:, n:2 * n - 1] = self._leaf(ids[:, :-1], ids[:, 1:], column[:-1])
        for i in range(n - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        live = np.arange(count)
        while True:
            top = tree[live, 1]
            open_ = top < NONE
            live, top = live[open_], top[open_]
            if not len(live):
                break
            i = top & (_AT - 1)
            j = after[live, i]
            k = after[live, j]
            new = self.token_of_rank[top >> 32]
            ids[live, i], ids[live, j] = new, -1
            after[live, i], before[live, k] = k, i
            h = before[live, i]
            inside = k < length[live]
            right = np.where(inside, ids[live, np.minimum(k, n - 1)], -1)
            left = np.where(h >= 0, ids[live, np.maximum(h, 0)], -1)
            tree[live, n + j] = NONE
            tree[live, n + i] = self._leaf(new, right, i)
            some = h >= 0
            tree[live[some], n + h[some]] = self._leaf(left[some], new[some], h[some])
            for rows, leaf in ((live, j), (live, i), (live[some], h[some])):
                at = (n + leaf) >> 1
                while at.size and at[0]:
                    tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
                    at >>= 1
        kept = ids >= 0
        ends = np.cumsum(kept.sum(axis=1))[:-1]
        return [x.tolist() for x in np.split(ids[kept], ends)]

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values of the pairs (left, right) that begin at ``at``; an id of -1 has no pair."""
        key = (left << 20) | (right & 0xFFFFF)
        found = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        known = (self.pair_keys[found] == key) & (left >= 0) & (right >= 0)
        return np.where(known, (self.pair_ranks[found] << 32) | at, NONE)

    def _remember(self, pieces: set[str]) -> None:
        """Encode pieces into the store: number of tokens, ids joined by commas, decoded bytes."""
        sized: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            data = p.encode()
            sized.setdefault(max(4, 1 << (len(data) - 1).bit_length()), []).append((p, data))
        for size, some in sized.items():
            step = max(1, BATCH // size)
            for lo in range(0, len(some), step):
                part = some[lo:lo + step]
                ids = (self.merge_many([d for _, d in part], size) if size <= SIDE_BY_SIDE
                       else [self.merge(d) for _, d in part])
                for (p, _), row in zip(part, ids):
                    ids_text, data = ",".join(map(str, row)), b"".join(map(self.bytes.__getitem__, row))
                    self.known[p] = (len(row), ids_text, data)
                    self.held += len(p) + len(ids_text) + len(data) + 120

    def _pieces(self, text: str) -> list[str]:
        if not self.special:
            return self.split(text)
        out = []
        for part in self.cut(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.split(part)
        return out

    def encoded(self, texts: list[str | None]) -> list[list[tuple[int, str, bytes]]]:
        """Per text, (number of tokens, ids, decoded bytes) of its pieces."""
        parts = [self._pieces(t) if t else [] for t in texts]
        distinct = set().union(*parts) - self.fixed.keys() if parts else set()
        new = distinct - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED or self.held + sum(map(len, new)) > REMEMBERED_BYTES:
            self.known, self.held = dict(self.fixed), 0
            new = distinct
        self._remember(new)
        get = self.known.__getitem__
        return [list(map(get, p)) for p in parts]

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for _, ids, _ in self.encoded([text])[0] for x in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        """Text of a token sequence; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join(self.bytes.get(i, b"") for i in ids).decode("utf-8", "replace")

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text: number of tokens, sha256 of the joined ids, sha256 of the decoded text."""
        out = []
        for got in self.encoded(texts):
            n, ids, data = zip(*got) if got else ((), (), ())
            decoded = b"".join(data).decode("utf-8", "replace").encode()
            out.append((sum(n), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                        hashlib.sha256(decoded).hexdigest()))
        return out


@lru_cache(2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text in ``into`` (array of int)."""
    def make():
        bpe = load(path)
        return lambda texts: [[np.array(bpe.encode(t), np.int32) for t in texts]]
    return append_columns(docs, [text], [T.StructField(into, T.ArrayType(T.IntegerType()))], make)


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of each token sequence in ``into`` (null ids: empty)."""
    def make():
        bpe = load(path)
        return lambda rows: [[bpe.decode(r or []) for r in rows]]
    return append_columns(docs, [ids], [T.StructField(into, T.StringType())], make)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded in one pass."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]

    def make():
        bpe = load(path)
        return lambda texts: list(map(list, zip(*bpe.digests(texts)))) or [[], [], []]
    return project_columns(docs, ["doc_id"], ["text"], fields, make)
