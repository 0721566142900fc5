"""Phrase collocation mining with vertically partitioned, depth-truncated suffix subtrees.

Texts are folded (A-Z to lower case), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``. Everything is counted per language; null is
``und``. A candidate is a phrase of 2 to ``MOST_WORDS`` words that occurs ``LEAST``
times. Cutting it in two, with l and r occurrences of the parts, scores
floor(2000000 a / (l + r)); its worst cut counts. A candidate whose words lie inside
a longer one that has 80 % of its occurrences is dropped.

1. Words are counted. A suffix can be a candidate's only as far as its words are
   frequent, and then as far as its neighbouring pairs are, so both are counted
   first, by hash for the pairs. Tasks know the frequent ones from a bitmap of
   hashes, of at most ``2**MOST_BITS`` bits: it may pass more, never less.
2. Every place in the text with a frequent pair gives a suffix, truncated where the
   frequent pairs end, at ``MOST_WORDS`` words at the latest. Equal suffixes are
   leaves with a total, added up in the tasks and then by one shuffle over all
   words of the suffix, so no key is hot.
3. The leaves are partitioned vertically by variable-length prefixes: one word if at
   most ``GROUP_LEAVES`` leaves share it, else a word more, and so on. Prefixes are
   grouped so that a group holds about that many leaves.
4. Each group is sorted and its subtree built on its own: a node's count is the total
   of the leaves below it. Nodes above a lengthened prefix lie in several groups;
   their partial totals are added up.

Counts of phrases and words are exact: hashes decide only what is looked at.

Edge cases: null and empty texts have no words; a null doc_id does not matter;
repeated rows count each; a language without candidates has no rows; no documents
give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import drop_scratch, free_shuffles, ship, slices, utf8, written
from strata.llm.features import mix

LEAST = 30
MOST_WORDS = 4
TOP = 2000
#: A longer candidate with this share of a candidate's occurrences, in percent, takes its place.
INSIDE = 80
SCALE = 2_000_000
#: Bits of the bitmaps that the driver and every task hold: 32 MB at most.
MOST_BITS = 28
#: Leaves of one subtree's prefix.
GROUP_LEAVES = 200_000
#: Distinct words and pairs that a task adds up before it hands them on.
HELD_WORDS, HELD_PAIRS = 300_000, 3_000_000
_END = b"."
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else c
              for c in range(256))


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of texts in order, with ``_END`` between pieces."""
    return b".".join(texts).translate(_FOLD).replace(b".", b" . ").split()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for part in slices(batch):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), utf8(part), strict=True):
            groups.setdefault(lang, []).append(text)
        for lang, texts in groups.items():
            yield lang, tokens(texts)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out():
        for lang, counts in held.items():
            counts.pop(_END, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()),
                 pa.array(list(counts), pa.binary()).cast(pa.string()),
                 pa.array(list(counts.values()), pa.int64())], names=["lang", "phrase", "n"])
        held.clear()

    for batch in batches:
        for lang, words in _by_lang(batch):
            held.setdefault(lang, Counter()).update(words)
        if sum(map(len, held.values())) > HELD_WORDS:
            yield from out()
    yield from out()


def _bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """Bits, about 16 for each of the ``n`` hashes, set at their leading bits."""
    bits = min(MOST_BITS, max(15, (16 * n).bit_length()))
    slot = F.shiftrightunsigned(F.col("hash"), 64 - bits) + 1       # Spark's bitmaps begin at 1
    rows = (hashes.select(F.bitmap_bucket_number(slot).alias("b"),
                          F.bitmap_bit_position(slot).alias("p"))
            .groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).toArrow())
    size = 1 << 12      # bytes of one of Spark's bitmaps
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, raw in zip(rows.column("b").to_pylist(), rows.column("bits").to_pylist(), strict=True):
        out[size * (b - 1):size * b] = np.frombuffer(raw, np.uint8)
    return out


def _among(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes.view(np.uint64) >> np.uint64(64 - (len(bitmap) * 8 - 1).bit_length())
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _coded(lang: str, words: list[bytes], bitmap: np.ndarray
           ) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, the number of each word in them, whether each is frequent, its hash).

    A word's hash is that of Spark's ``xxhash64(lang, word)``.
    """
    distinct = list(dict.fromkeys(words))
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    digest = xxhash.xxh64_intdigest
    code = np.fromiter((digest(w, seed) for w in distinct), np.uint64, len(distinct))
    often = _among(bitmap, code)
    if _END in place:
        often[place[_END]] = False
    return distinct, at, often, code


def _pair_hashes(at: np.ndarray, often: np.ndarray, code: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(places of two frequent words in a row, their hashes)."""
    ok = often[at]
    first = np.flatnonzero(ok[:-1] & ok[1:])
    c = code[at]
    return first, mix(c[first] * np.uint64(0x9E3779B97F4A7C15) + c[first + 1]).view(np.int64)


def _count_pairs(bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out():
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["hash", "n"])

        for batch in batches:
            for lang, words in _by_lang(batch):
                _, at, often, code = _coded(lang, words, bitmap)
                held.append(_pair_hashes(at, often, code)[1])
                size += len(held[-1])
            if size > HELD_PAIRS:
                yield out()
                held, size = [], 0
        if held:
            yield out()
    return run


def _leaves(word_bits: np.ndarray, pair_bits: np.ndarray):
    """Truncated suffixes with their number, equal ones of a slice together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words in _by_lang(batch):
                distinct, at, often, code = _coded(lang, words, word_bits)
                first, pair = _pair_hashes(at, often, code)
                linked = np.zeros(len(at) + MOST_WORDS, bool)
                linked[first[_among(pair_bits, pair)]] = True
                start = np.flatnonzero(linked)
                if not len(start):
                    continue
                # words of each suffix, 0 where it has ended, numbered within the slice
                table = np.zeros((len(start), MOST_WORDS), np.int64)
                number = np.concatenate([at + 1, np.zeros(MOST_WORDS, np.int64)])
                table[:, 0] = number[start]
                going = np.ones(len(start), bool)
                for k in range(1, MOST_WORDS):
                    going &= linked[start + k - 1]
                    table[:, k] = np.where(going, number[start + k], 0)
                order = np.lexsort(table.T[::-1])
                table = table[order]
                new = np.flatnonzero(np.concatenate(
                    [[True], (table[1:] != table[:-1]).any(axis=1)]))
                n = np.diff(np.append(new, len(table)))
                phrases = [b" ".join([distinct[x - 1] for x in row if x])
                           for row in table[new].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()),
                     pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                    names=["lang", "phrase", "n"])
    return run


def partitioned(leaves: DataFrame, group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """``leaves`` (lang, words, n) with their ``prefix`` and the ``grp`` of that prefix.

    Nodes of fewer words than ``from_depth`` may lie in other groups as well.
    """
    spark = leaves.sparkSession
    parts = leaves.select("*", F.slice("words", 1, 1).alias("prefix"), F.lit(1).alias("from_depth"))
    for depth in range(1, MOST_WORDS):
        large = written(parts.groupBy("lang", "prefix").agg(F.count("*").alias("size"))
                        .where(F.col("size") > group_leaves)
                        .select("lang", "prefix", F.lit(True).alias("large")), "phrase-prefixes")
        if large.isEmpty():
            break
        longer = F.col("large").isNotNull()     # a leaf that ends here keeps its prefix
        parts = written(parts.join(large, ["lang", "prefix"], "left").select(
            "lang", "words", "n", F.when(longer, F.slice("words", 1, depth + 1))
            .otherwise(F.col("prefix")).alias("prefix"),
            F.when(longer, depth + 1).otherwise(F.col("from_depth")).alias("from_depth")),
            "phrase-parts")
        free_shuffles(spark)
    # half full on average: prefixes are hashed, and each is within the budget
    groups = 2 * leaves.count() // group_leaves + 1
    return parts.withColumn("grp", F.pmod(F.xxhash64("lang", "prefix"), F.lit(groups)))


def subtree(langs: np.ndarray, words: np.ndarray, n: np.ndarray, depth: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each node at ``depth``, its count) of sorted leaves.

    ``words`` has a row of word numbers per leaf, -1 beyond its end.
    """
    rows = np.flatnonzero(words[:, depth - 1] >= 0)
    if not len(rows):
        return rows, n[:0]
    key = np.column_stack([langs, words[:, :depth]])[rows]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
    return rows[new], np.add.reduceat(n[rows], new)


def _subtrees(least: int):
    """Nodes of each group's subtree, from a partition sorted by group, language and words."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("words").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().dictionary_encode()
        number = np.full((table.num_rows, MOST_WORDS), -1, np.int64)
        number[np.arange(MOST_WORDS) < size[:, None]] = flat.indices.to_numpy()
        spelled = flat.dictionary.to_pylist()
        lang = table.column("lang").combine_chunks().dictionary_encode()
        code, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
        n, whole = table.column("n").to_numpy(), table.column("from_depth").to_numpy()
        out: list[list] = [[], [], [], []]
        for depth in range(2, MOST_WORDS + 1):
            rows, total = subtree(code, number, n, depth)
            keep = (total >= least) | (whole[rows] > depth)
            for r, t in zip(rows[keep].tolist(), total[keep].tolist(), strict=True):
                out[0].append(names[code[r]])
                out[1].append(" ".join([spelled[x] for x in number[r, :depth]]))
                out[2].append(depth)
                out[3].append(t)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(
                out, (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)],
            names=["lang", "phrase", "size", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("grp").to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            if held and held[-1].column("grp")[0].as_py() != group[0]:
                yield solve(pa.Table.from_batches(held).combine_chunks())
                held = []
            for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield solve(pa.Table.from_batches([*held, batch.slice(a, b - a)]).combine_chunks())
                held = []
            held.append(batch.slice(cuts[-2]))
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())
    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, group_leaves: int = GROUP_LEAVES,
                  ) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of words and phrases with ``least`` or more; (lang, words) in all)."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = written(texts.mapInArrow(_count_words, "lang string, phrase string, n long")
                    .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrase-words")
    free_shuffles(spark)
    totals = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    often = written(words.where(F.col("n") >= least), "phrase-often")
    drop_scratch(words)
    word_bits = _bitmap(often.select(F.xxhash64("lang", "phrase").alias("hash")), often.count())
    pairs = written(texts.mapInArrow(_count_pairs(word_bits), "hash long, n long")
                    .groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
                    .select("hash"), "phrase-pairs")
    free_shuffles(spark)
    pair_bits = _bitmap(pairs, pairs.count())
    leaves = written(texts.mapInArrow(_leaves(word_bits, pair_bits),
                                      "lang string, phrase string, n long")
                     .groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                     .select("lang", F.split("phrase", " ", -1).alias("words"), "n"),
                     "phrase-leaves")
    free_shuffles(spark)
    order = ["grp", "lang", "words"]
    nodes = (partitioned(leaves, group_leaves)
             .select(*order, "n", "from_depth")
             .repartition("grp").sortWithinPartitions(*order)
             .mapInArrow(_subtrees(least), "lang string, phrase string, size int, n long")
             .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= least))
    counts = written(nodes.union(often.select("lang", "phrase", F.lit(1), "n")), "phrase-counts")
    drop_scratch(leaves)
    free_shuffles(spark)
    return counts, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP,
                 group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language."""
    counts, totals = phrase_counts(docs, least, group_leaves)
    key = ["lang", "phrase"]
    long = counts.where("size > 1").select(*key, "size", F.col("n").alias("a"))
    words = long.withColumn("w", F.split("phrase", " ", -1))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cuts = words.select(*key, "size", "a", "w", F.explode(F.sequence(
        F.lit(1), F.col("size") - 1)).alias("k")).select(
        *key, "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    of = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    cuts = cuts.join(of, ["lang", "left"]).join(of.toDF("lang", "right", "r"), ["lang", "right"])
    # products and sums may pass 64 bits
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCALE}) div "
                   "(CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    worst = cuts.groupBy(*key, "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")).select(
        *key, "a", "cut.l", "cut.r", "cut.score")
    # phrases of two words or more that lie inside a longer one
    size = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("len")
    inside = words.where("size > 2").select("lang", "w", "size", "a", size).select(
        "lang", "w", "a", "len", F.explode(F.sequence(
            F.lit(1), F.col("size") - F.col("len") + 1)).alias("at")).select(
        "lang", part(F.col("at"), F.col("len")).alias("phrase"), "a")
    outer = inside.groupBy(*key).agg(F.max("a").alias("most"))
    left = worst.join(outer, key, "left").where(F.expr(
        f"most IS NULL OR 100 * CAST(most AS DECIMAL(20, 0)) < {INSIDE} * CAST(a AS DECIMAL(20, 0))"))
    # a language may hold most rows: Spark limits each task's rows of a window before the shuffle
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def brute_force(docs: list[tuple], least: int = LEAST, top: int = TOP) -> list[tuple]:
    """Reference result for small inputs of (lang, text): every phrase is counted."""
    import re
    f: dict[str, Counter] = {}
    for lang, text in docs:
        mine = f.setdefault("und" if lang is None else lang, Counter())
        low = (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, MOST_WORDS + 1):
                mine.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, mine in f.items():
        n = sum(v for p, v in mine.items() if len(p) == 1)
        able = {p: a for p, a in mine.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in able.items():
            score, k = min((SCALE * a // (mine[p[:k]] + mine[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= INSIDE * a
                       and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                       for q, b in able.items()):
                kept.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return out
