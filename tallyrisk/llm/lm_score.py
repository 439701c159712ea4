"""Scoring texts with a weighted backoff automaton (operator 9).

The model is a trigram model learned from the training documents. Every order is smoothed by the next
lower one: ``P(w | u v) = (c(u v w) + k3 P(w | v)) / (c(u v) + k3)``, ``P(w | v) = (c(v w) + k2 P(w)) /
(c(v) + k2)``, ``P(w) = (c(w) + 1) / (N + V + 1)``. As an automaton: a root state, a state per known word
(the last word read) and a state per seen pair (the last two). A seen n-gram is an arc, weighted by its
log-probability, that leads to the state of its last two words. Failure arcs lead from a pair to its second
word, ``log10(k3 / (c(u v) + k3))``, and from a word to the root, ``log10(k2 / (c(v) + k2))``. A text is read
once, left to right, from the state of the end token; every step falls along failure arcs until the state has
an arc for the token, takes it, and hands the state it leads to on to the next step. Weights out of each state
sum to one, the unknown word included.

Scale. The model is never held whole. Documents are dealt into blocks; a block sends the hashes of its
distinct words, pairs and triples with its own training counts to the counting tasks, one per hash range,
which add them up over all blocks and answer each block with the totals of just what it asked for. The block
builds the part of the automaton that its own texts can reach, so memory follows the block and not the
corpus, and what is exchanged grows with the input. Rows are dealt by their place in the table, so repeated
rows spread over all blocks. ``docs`` is read more than once and has to come in the same order each time, as a
stored table does; write any other frame first.

Words are told apart by 64-bit hashes: among V distinct words about V**2 / 2**65 pairs share one (under 1 for
4 billion words). Pairs and triples are told apart by as many bytes of a 64-bit hash as leave a chance below
one in 2**20 that an n-gram shares its hash with any other (``key_bytes``); its count is then too high.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` counts as the
empty string for the split; repeated rows count and are scored as often as they occur; with no
training token every probability is 1; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.common import chunks, index_words, map_arrow, merge_counts

BLOCK_BYTES = 8 << 20     # text per block; one longer text is a block's largest part
RANGE_BYTES = 32 << 20    # text per hash range of the counting tasks
MIN_BLOCKS = 64
STEP_TOKENS = 1 << 18     # tokens whose steps are taken together
BACKOFF = (300.0, 5.0)    # k2, k3: pseudo-counts a word and a pair state give to their failure arc (see README)
PENDING_WORDS = 400_000   # distinct words a counting task holds before it passes them on
END_HASH = xxhash.xxh64_intdigest(b"\n")   # no word holds a line feed


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words, then of the end token."""
    return np.array([xxhash.xxh64_intdigest(w) for w in words] + [END_HASH], np.uint64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Range of each hash; grows with the hash, so sorted hashes have sorted ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))


def _planes(x: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first, then all second bytes, ...: small numbers leave
    long runs of zeros, which the shuffle's compression takes out."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return _planes(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, np.uint64), dtype=np.uint64)


def pack_counts(n: np.ndarray) -> bytes:
    """Counts in the least width that holds the largest of them, which the first byte names."""
    kind = np.min_scalar_type(int(n.max())) if len(n) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + _planes(n.astype(kind))


def unpack_counts(data: bytes) -> np.ndarray:
    return _unplanes(data[1:], np.dtype(f"u{data[0]}")).astype(np.int64)


def key_bytes(tokens: int) -> int:
    """Bytes of the hash that pairs and triples travel with: at least 20 bits more than the tokens need."""
    return min(8, -(-(max(tokens, 1 << 28).bit_length() - 1 + 20) // 8))


def _mix(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Hash of the sequences a b, of which the upper ``size`` bytes are left."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h >> np.uint64(64 - 8 * size) << np.uint64(64 - 8 * size)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each key's place among them, and one position of each."""
    order = np.argsort(keys)
    run = keys[order]
    first = np.ones(len(run), bool)
    np.not_equal(run[1:], run[:-1], out=first[1:])
    place = np.empty(len(run), np.int32)
    place[order] = np.cumsum(first, dtype=np.int32) - 1
    return run[first], place, order[first]


def with_training_flag(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out: whether crc32 of the id as text leaves 2 modulo 7."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select("doc_id", "text", (F.crc32(F.encode(name, "UTF-8")) % 7 == 2).alias("held_out"))


def vocabulary_totals(docs: DataFrame, buckets: int) -> tuple[int, int]:
    """(N, V): tokens and distinct tokens of the training texts, the end token included."""
    def count(batches):
        pending: dict[bytes, int] = {}
        ends = 0

        def flush():
            keys = _word_hashes(list(pending))
            n = np.array([*pending.values(), 0], np.int64)
            keys, n = merge_counts(keys, n)
            cut = _slices(keys, buckets)
            pending.clear()
            live = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [pa.array(live.astype(np.int32)), pa.array([pack_keys(keys[cut[i]:cut[i + 1]]) for i in live], pa.binary()),
                 pa.array([pack_counts(n[cut[i]:cut[i + 1]]) for i in live], pa.binary())],
                names=["bucket", "k", "n"])
        for b in batches:
            texts, held = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = [t for t, out in zip(texts, held) if not out]
            ends += len(texts)
            for lo, hi in chunks(texts):
                words, ids, _ = index_words(texts[lo:hi], lower=True)
                for w, n in zip(words, np.bincount(ids, minlength=len(words)).tolist()):
                    pending[w] = pending.get(w, 0) + n
                if len(pending) > PENDING_WORDS:
                    yield flush()
        pending[b"\n"] = ends
        yield flush()

    def total(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_keys(x) for x in table.column("k").to_pylist()])
        n = np.concatenate([unpack_counts(x) for x in table.column("n").to_pylist()])
        _, n = merge_counts(keys, n)
        return pa.table({"n": pa.array([int(n.sum())]), "v": pa.array([int((n > 0).sum())])})
    parts = map_arrow(docs.select("text", "held_out"), count, "bucket int, k binary, n binary")
    r = parts.groupBy("bucket").applyInArrow(total, "n long, v long").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return int(r["n"] or 0), int(r["v"] or 0)


class Block:
    """Tokens of a block's texts: distinct words, pairs and triples, by sorted hash. A triple is a pair
    and the word after it; the first token of a text ends no triple (``triple`` is -1 there)."""

    def __init__(self, texts: list[str | None], held_out: list[bool], size: int = 8):
        words, ids, offsets = index_words(texts, lower=True)
        self.n_tokens = np.diff(offsets) + 1
        self.offsets = np.concatenate([[0], np.cumsum(self.n_tokens)])
        first = np.zeros(int(self.offsets[-1]), bool)
        first[self.offsets[:-1]] = True
        self.word_keys, place, _ = _distinct(_word_hashes(words))
        self.end = int(place[-1])
        self.tokens = np.full(len(first), self.end, np.int32)
        self.tokens[~np.append(first[1:], True)[:len(first)]] = place[ids]
        del words, ids
        trained = np.repeat(~np.array(held_out, bool), self.n_tokens)
        self.word_train = np.bincount(self.tokens, trained, len(self.word_keys)).astype(np.uint32)

        before = np.append(np.int32(self.end), self.tokens[:-1])[:len(first)]   # texts start from the end token
        self.pair_keys, self.pair, at = _distinct(_mix(self.word_keys[before], self.word_keys[self.tokens], size))
        self.pair_before, self.pair_word = before[at], self.tokens[at]
        self.pair_train = np.bincount(self.pair, trained, len(at)).astype(np.uint32)
        del before

        later = np.flatnonzero(~first)
        self.triple_keys, place, at = _distinct(_mix(
            self.pair_keys[self.pair[later - 1]] ^ np.uint64(0xA5A5A5A5A5A5A5A5), self.word_keys[self.tokens[later]], size))
        at = later[at]
        self.triple = np.full(len(first), -1, np.int32)
        self.triple[later] = place
        self.triple_before, self.triple_tail = self.pair[at - 1], self.pair[at]   # the pairs it starts and ends with
        self.triple_train = np.bincount(place, trained[later], len(at)).astype(np.uint32)


KINDS = ("word", "pair", "triple")
CELL = "".join(f", {k}_keys binary, {k}_n binary" for k in KINDS)
ANSWER = "".join(f", {k}_n binary" for k in KINDS)


def _request(buckets: int, size: int):
    def run(table: pa.Table) -> pa.Table:
        b = Block(table.column("text").to_pylist(), table.column("held_out").to_pylist(), size)
        cuts = {k: _slices(getattr(b, f"{k}_keys"), buckets) for k in KINDS}
        live = np.flatnonzero(sum(np.diff(c) for c in cuts.values()))
        block = table.column("block")[0].as_py()
        out = {"bucket": pa.array(live.astype(np.int32)), "block": pa.array([block] * len(live), pa.int32())}
        for k, c in cuts.items():
            for name, x, pack in ((f"{k}_keys", getattr(b, f"{k}_keys"), pack_keys),
                                  (f"{k}_n", getattr(b, f"{k}_train"), pack_counts)):
                out[name] = pa.array([pack(x[c[i]:c[i + 1]]) for i in live], pa.binary())
        return pa.table(out)
    return run


def _count(table: pa.Table) -> pa.Table:
    """Totals over all blocks of one hash range, sent back in the order of each request."""
    def totals(kind: str):
        parts = [unpack_keys(x) for x in table.column(f"{kind}_keys").to_pylist()]
        n = np.concatenate([unpack_counts(x) for x in table.column(f"{kind}_n").to_pylist()])
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        every = np.bincount(at, n) if len(at) else np.zeros(0)
        out, lo = [], 0
        for p in parts:
            out.append(pack_counts(every[at[lo:lo + len(p)]]))
            lo += len(p)
        return pa.array(out, pa.binary())
    return pa.table({"block": table.column("block").combine_chunks(), "bucket": table.column("bucket").combine_chunks(),
                     **{f"{k}_n": totals(k) for k in KINDS}})


class BackoffAutomaton:
    """The states and arcs that a block can reach. With n words, state 0 is the root, 1 + w the word w and
    1 + n + p the pair p. ``level`` arrays are by order: 0 the root's arcs, 1 a word's, 2 a pair's."""

    def __init__(self, block: Block, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, n: int, v: int,
                 backoff: tuple[float, float]):
        b, (k2, k3), size = block, backoff, len(words)
        self.block, self.known = block, words > 0
        one = (words + 1.0) / (n + v + 1.0)
        two = (pairs + k2 * one[b.pair_word]) / (words[b.pair_before] + k2)
        three = (triples + k3 * two[b.triple_tail]) / (pairs[b.triple_before] + k3)
        self.has_arc = [np.ones(size, bool), pairs > 0, triples > 0]
        self.arc = [np.log10(one), np.log10(two), np.log10(three)]
        self.failure = np.concatenate([[0.0], np.log10(k2 / (words + k2)), np.log10(k3 / (pairs + k3))])
        word_state = np.where(self.known, np.arange(size) + 1, 0).astype(np.int32)
        self.fails_to = np.concatenate([np.zeros(1 + size, np.int32), word_state[b.pair_word]])
        # Where an arc leads: the longest seen ending of what has been read.
        self.leads_to = np.where(pairs > 0, np.arange(len(pairs), dtype=np.int32) + 1 + size, word_state[b.pair_word])
        self.start, self.first_pair = int(word_state[b.end]), 1 + size

    def states(self) -> np.ndarray:
        """The state before each token: where the step before has led, or the start at a text's first token."""
        b = self.block
        state = np.empty(len(b.tokens), np.int32)
        state[1:] = self.leads_to[b.pair[:-1]]
        state[b.offsets[:-1]] = self.start
        return state

    def read(self) -> np.ndarray:
        """Weight of every token, from left to right in slices: each pass falls one failure arc further
        with all tokens whose state has no arc for them."""
        b = self.block
        state, weight = self.states(), np.zeros(len(b.tokens))
        for lo in range(0, len(b.tokens), STEP_TOKENS):
            todo = np.arange(lo, min(lo + STEP_TOKENS, len(b.tokens)))
            while len(todo):
                at, rest = state[todo], []
                level = (at > 0).astype(np.int8) + (at >= self.first_pair)
                for order, arcs in enumerate((b.tokens, b.pair, b.triple)):
                    here = todo[level == order]
                    arc = arcs[here]
                    takes = self.has_arc[order][arc]
                    weight[here[takes]] += self.arc[order][arc[takes]]
                    rest.append(here[~takes])
                todo = np.concatenate(rest)
                weight[todo] += self.failure[state[todo]]
                state[todo] = self.fails_to[state[todo]]
        return weight


def _by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each text's own tokens (there is always one), whatever texts stand beside it."""
    return np.add.reduceat(values, offsets[:-1])


def _score(n: int, v: int, backoff: tuple[float, float], size: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(docs.column("text").to_pylist(), docs.column("held_out").to_pylist(), size)
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")

        def gather(kind):
            got = answers.column(f"{kind}_n").to_pylist()
            x = np.concatenate([unpack_counts(got[i]) for i in order]) if got else np.zeros(0, int)
            if len(x) != len(getattr(b, f"{kind}_keys")):
                raise ValueError("a block's answers do not match its request")
            return x
        lm = BackoffAutomaton(b, *(gather(k) for k in KINDS), n, v, backoff)
        return pa.table({
            "doc_id": docs.column("doc_id").combine_chunks(), "held_out": docs.column("held_out").combine_chunks(),
            "n_tokens": pa.array(b.n_tokens.astype(np.int64)),
            "n_known": pa.array(_by_text(lm.known[b.tokens].astype(np.int64), b.offsets)),
            "train_tokens": pa.array(np.full(docs.num_rows, n, np.int64)),
            "base_score": pa.array(_by_text(lm.arc[0][b.tokens], b.offsets)),
            "score": pa.array(_by_text(lm.read(), b.offsets))})
    return run


def score_documents(docs: DataFrame, backoff: tuple[float, float] = BACKOFF, block_bytes: int = BLOCK_BYTES,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    bytes_ = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("b")).first()["b"] or 0
    blocks = max(MIN_BLOCKS, -(-int(bytes_) // block_bytes))
    ranges = max(MIN_BLOCKS, -(-int(bytes_) // range_bytes))
    src = with_training_flag(docs)
    n, v = vocabulary_totals(src, ranges)
    size = key_bytes(n)
    kind = dict(src.dtypes)["doc_id"]
    src = src.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    asked = src.groupBy("block").applyInArrow(_request(ranges, size), "bucket int, block int" + CELL)
    answers = asked.groupBy("bucket").applyInArrow(_count, "block int, bucket int" + ANSWER)
    return src.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(n, v, backoff, size), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                     "train_tokens long, base_score double, score double")
