"""Benchmark decontamination with a broadcast hash set of test n-grams (operator 7).

Built-in DataFrame functions only. Texts are normalised to lower-case (A-Z) word sequences; each
benchmark item gives its ``size``-word windows, or itself where it is shorter. The set of
distinct windows (hash, words, item ids) is broadcast, in blocks where its measured size exceeds
``broadcast_bytes`` (each block takes another pass over the documents). One pass over the documents hashes each
window and tests a bitmap of the set's hashes inside the text's own row; only windows that pass leave it, each
with its own words, to probe the set and be verified word by word in the same stage. So the cost of a text is linear
in its length. Only hits and one small row per document are shuffled.

Defined results: a null text has no words and no hits; documents that are repeated (same id and
text) are returned as often as they occur; a null ``item_id`` counts as the empty string;
repeated items count once; an empty benchmark leaves every document clean; an empty document
table gives an empty result; other columns are ignored or, by the filters, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.common import guarded, materialize

SIZE = 10
BROADCAST_BYTES = 64 << 20
BITS_PER_WINDOW = 32      # of the bitmap; about 3 % of the other windows pass it
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # ASCII but digits and lower-case letters
RAW_WORD = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised_words(text: Column) -> Column:
    parts = F.split(F.translate(text, UPPER, LOWER), NO_WORD, -1)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _windows(words: Column, length: Column | int) -> Column:
    """Start positions (0-based) of all windows of ``length`` words."""
    last = F.size(words) - length
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def with_window_hashes(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    """``df`` with, per length n, the column ``_h{n}``: hashes of the n-word windows in order.

    Windows are hashed by doubling: a window of 2k words from its two halves, any other length
    from its powers of two, so a text costs a few passes however long it is. Each level is a
    projection of its own, so it is computed once.
    """
    def join(left: str, right: str, shift: int) -> Column:
        return F.zip_with(left, F.slice(right, shift + 1, F.greatest(F.size(right) - shift, F.lit(0))),
                          lambda a, b: F.xxhash64(a, b))
    powers = [1]
    out = df.withColumn("_p1", F.transform(words, lambda w: F.xxhash64(w)))
    while 2 * powers[-1] <= max(lengths, default=0):
        k = powers[-1]
        out = out.withColumn(f"_p{2 * k}", join(f"_p{k}", f"_p{k}", k))
        powers.append(2 * k)
    for n in lengths:
        got, size = None, 0
        for k in reversed(powers):
            if n - size >= k:
                if got is None:
                    got = f"_p{k}"
                else:
                    out = out.withColumn(f"_s{n}_{k}", join(got, f"_p{k}", size))
                    got = f"_s{n}_{k}"
                size += k
        out = out.withColumn(f"_h{n}", F.slice(got, 1, F.greatest(F.size(words) - n + 1, F.lit(0))))
    return out


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(gram, len, items): distinct windows of the benchmark with the items that hold them."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             normalised_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    grams = (words.select("item", "words", length.alias("len"))
             .select("item", "words", "len", F.explode(_windows(F.col("words"), F.col("len"))).alias("i"))
             .select("item", "len", F.slice("words", F.col("i") + 1, F.col("len")).alias("gram")))
    return grams.groupBy("gram", "len").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _bitmap(hashes: DataFrame, n: int) -> tuple[Column, int]:
    """A constant array of longs whose bits mark the hashes (column ``gh``), and its length: a power of two of at
    least ``BITS_PER_WINDOW`` bits a hash, so it is bounded as the broadcast set is."""
    words = max(1 << (max(n * BITS_PER_WINDOW, 64) - 1).bit_length() - 6, 1)
    slot = F.shiftrightunsigned("gh", 6).bitwiseAND(F.lit(words - 1))
    bit = F.expr("shiftleft(1L, cast(gh & 63 as int))")
    marked = hashes.groupBy(slot.alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = hashes.sparkSession.range(words).join(marked, "id", "left")
    row = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    text = every.agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["bits"].cast("string")),
                                  ",").alias("t")).first()["t"]
    # Folded to one constant before the query runs.
    return F.split(F.lit(text), ",").cast("array<bigint>"), words


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, th (text hash), n_words, copies,
    spans (array of {pos, len}) and items (array of ids as text)."""
    grams = materialize(benchmark_windows(benchmark, size), "bench-windows")
    measure = grams.agg(
        F.sum(F.length(F.concat_ws(" ", "gram")) + F.length(F.concat_ws(",", "items")) + 64).alias("b"),
        F.collect_set("len").alias("lens")).first()
    lengths = sorted(measure["lens"] or [])
    gh = F.lit(None).cast("long")
    for n in lengths:
        gh = F.when(F.col("len") == n, F.get(f"_h{n}", F.lit(0))).otherwise(gh)
    # A probe of length 0 stands for the text itself and carries its word count.
    nothing = F.array().cast("array<string>")
    whole = grams.sparkSession.range(1).select(F.lit(0).cast("long").alias("gh"), F.lit(0).alias("glen"),
                                               nothing.alias("ggram"), F.lit(None).cast("array<string>").alias("items"))
    grams = materialize(with_window_hashes(grams, "gram", lengths).select(
        gh.alias("gh"), F.col("len").alias("glen"), F.col("gram").alias("ggram"), "items"), "bench-hashes")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), normalised_words(F.col("text")).alias("words"))
    rows = with_window_hashes(rows, "words", lengths)
    head = F.array(F.struct(F.lit(0).alias("pos"), F.lit(0).alias("len"), F.lit(0).cast("long").alias("h"),
                            nothing.alias("gram")))
    # The set is broadcast in blocks of at most ``broadcast_bytes``; one block is the usual case.
    blocks = max(1, -(-int(measure["b"] or 0) // broadcast_bytes))
    found = None
    for k in range(blocks):
        block = grams.filter(F.pmod("gh", F.lit(blocks)) == k) if blocks > 1 else grams
        bits, words = _bitmap(block, block.count())

        def marked(h: Column) -> Column:
            at = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)).cast("int")
            return F.getbit(F.get(bits, at), h.bitwiseAND(F.lit(63)).cast("int")) == 1
        probes = head
        for n in lengths:
            probes = F.concat(probes, F.array_compact(F.transform(f"_h{n}", lambda h, i: F.when(marked(h), F.struct(
                i.alias("pos"), F.lit(n).alias("len"), h.alias("h"), F.slice("words", i + 1, F.lit(n)).alias("gram"))))))
        probed = rows.select("doc_id", "th", F.size("words").cast("long").alias("n_words"), F.inline(probes))
        block = block.unionByName(whole) if k == 0 else block
        match = (F.col("h") == F.col("gh")) & (F.col("len") == F.col("glen")) & (F.col("gram") == F.col("ggram"))
        part = probed.join(F.broadcast(block), match).select(
            "doc_id", "th", "n_words", (F.col("len") == 0).alias("head"),
            F.when(F.col("len") > 0, F.struct("pos", "len")).alias("span"), "items")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "th", "n_words").agg(
        F.sum(F.col("head").cast("long")).alias("copies"), F.collect_set("span").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _covered(spans: str) -> Column:
    """Distinct word positions inside the spans."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(
        s["pos"], s["pos"] + s["len"] - 1))))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, contaminated for every row of ``docs``."""
    found = hits(docs, benchmark, size, broadcast_bytes)
    n_hit = F.size(_covered("spans")).cast("long")
    out = found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       "items", (F.size("spans") > 0).alias("contaminated"), "copies")
    return out.select("*", F.explode(F.expr("sequence(1L, copies)")).alias("_copy")).drop("copies", "_copy")


@guarded("doc_id", "text")
def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", size: int = SIZE,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without contaminated documents (mode "document") or with the hit words cut out of
    their texts (mode "span": each run of hit words, and what stands between them, goes)."""
    bad = hits(docs, benchmark, size, broadcast_bytes).filter(F.size("spans") > 0)
    bad = materialize(bad.select(F.col("doc_id").alias("_b_id"), F.col("th").alias("_b_th"),
                                 _covered("spans").alias("_b_at")), "contaminated")
    match = F.col("doc_id").eqNullSafe(F.col("_b_id")) & (F.xxhash64("text") == F.col("_b_th"))
    if mode == "document":
        return docs.join(bad.drop("_b_at"), match, "left_anti")
    if mode != "span":
        raise ValueError(f"unknown mode {mode!r}")
    joined = docs.join(bad, match, "left")
    words = F.regexp_extract_all(F.col("text"), F.lit(RAW_WORD), F.lit(1))
    between = F.split("text", RAW_WORD, -1)
    flagged = F.map_from_arrays(F.col("_b_at"), F.transform("_b_at", lambda x: F.lit(True)))
    last = F.size(words) - 1
    # between[i] precedes word i; it goes when both its neighbours are hit.
    keep = F.transform(F.sequence(F.lit(0), last + 1), lambda i: F.struct(
        F.element_at(between, i + 1).alias("gap"), F.when(i <= last, F.element_at(words, F.least(i, last) + 1))
        .otherwise("").alias("word"), F.map_contains_key("_b_map", i).alias("hit"),
        F.map_contains_key("_b_map", i - 1).alias("before")))
    cut = F.array_join(F.transform("_b_parts", lambda p: F.concat(
        F.when(p["hit"] & p["before"], "").otherwise(p["gap"]), F.when(p["hit"], "").otherwise(p["word"]))), "")
    return (joined.withColumn("_b_map", F.when(F.col("_b_at").isNotNull(), flagged))
            .withColumn("_b_parts", F.when(F.col("_b_at").isNotNull(), keep))
            .withColumn("text", F.when(F.col("_b_at").isNotNull(), cut).otherwise(F.col("text")))
            .select(*[f"`{c}`" for c in docs.columns]))
