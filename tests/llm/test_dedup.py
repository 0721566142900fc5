"""Exact dedup, SimHash, fuzzy lines, repeats: against brute force."""

import hashlib
from collections import defaultdict

import pytest
import xxhash

from strata.llm import components, content_dedup, line_dedup, simhash, suffix_dedup
from tests.llm.helpers import LINE, PASSAGE, awkward, docs_of, empty, frame, pairs_of

BIG = 2**63 - 1


def _fill(pairs):
    return [(BIG if d is None else d, t or "") for d, t in pairs]


def _strip(t):
    return "".join(c for c in t if c not in " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_exact_groups(spark, source):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    got = content_dedup.exact_groups(df).collect()
    pairs = _fill(pairs_of(df))
    groups = defaultdict(list)
    for d, t in pairs:
        groups[_strip(t)].append((-len(t), d))
    sha = {hashlib.sha256(b.encode()).hexdigest(): min(g)[1] for b, g in groups.items()}
    sizes = {hashlib.sha256(b.encode()).hexdigest(): len(g) for b, g in groups.items()}
    assert len(got) == len(pairs)
    for r in got:
        assert r.group_size == sizes[r.text_sha256]
        assert (BIG if r.keep_id is None else r.keep_id) == sha[r.text_sha256]
    assert sum(r.kept for r in got) == len(groups)


def test_exact_groups_hot_text_over_partitions(spark):
    rows = [(i, "same  text" if i % 2 else "same text") for i in range(4000)]
    rows += [(i, f"text {i}") for i in range(4000, 8000)]
    got = content_dedup.exact_groups(frame(spark, rows)).collect()
    hot = [r for r in got if r.group_size == 4000]
    assert len(hot) == 4000 and {r.keep_id for r in hot} == {1}
    assert [r.doc_id for r in got if r.kept and r.group_size == 4000] == [1]


def _slow_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def _near(pairs):
    fp = {(d, t): _slow_fingerprint(t) for d, t in set(pairs)}
    values = sorted(set(fp.values()))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (d, _), v in fp.items():
        least[find(v)] = min(least.get(find(v), BIG), d)
    return sorted((d, f"{fp[d, t]:016x}", least[find(fp[d, t])]) for d, t in pairs)


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_simhash(spark, source):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    got = sorted((BIG if r.doc_id is None else r.doc_id, r.fingerprint,
                  BIG if r.component_id is None else r.component_id)
                 for r in simhash.near_groups(df).collect())
    assert got == _near(_fill(pairs_of(df)))


def test_simhash_links_are_all_pairs_within_two_bits(spark):
    import random
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            for _ in range(rng.randint(1, 3)):
                b ^= 1 << rng.randrange(64)
            fps.add(b)
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    comp = {r.node: r.component for r in components.components(links).collect()}
    want = {f: f for f in signed}

    def find(x):
        while want[x] != x:
            x = want[x]
        return x

    for a in signed:
        for b in signed:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                want[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: comp.get(f, f) for f in signed} == {f: find(f) for f in signed}
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_chain_star_and_repeats(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    extra = [(5000, 5000), (7001, 7000), (7000, 7001), (-5, -9)]
    links = spark.createDataFrame(chain + star + extra, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == ({i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 500)}
                   | {7001: 7000, -5: -9})
    assert components.components(links.where("a < -100")).count() == 0


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_repeats(spark, source):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    got = sorted((BIG if r[0] is None else r[0], *r[1:])
                 for r in suffix_dedup.repeat_report(df).collect())
    pairs = _fill(pairs_of(df))
    if source == "awkward":        # one text per id for the reference
        pairs = [p for p in pairs if p[0] != BIG]
        got = [r for r in got if r[0] != BIG]
    want = suffix_dedup.brute_force(pairs)
    assert got == sorted((d, *want[d]) for d, _ in pairs)


def test_repeats_without_id_come_last(spark):
    rows = [(None, f"x {PASSAGE}"), (5, f"y {PASSAGE}")]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.repeat_report(frame(spark, rows)).collect()}
    assert got == {None: 40, 5: 0}


def test_repeats_of_a_hot_passage_take_the_long_prefix(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 10)
    rows = [(i, f"own{i} words{i} {PASSAGE} more{i} of{i}") for i in range(60)]
    rows += [(100 + i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(10)]
    got = {r.doc_id: tuple(r[1:]) for r in suffix_dedup.repeat_report(frame(spark, rows)).collect()}
    assert got == suffix_dedup.brute_force(rows)


def test_repeats_random_texts(spark):
    import random
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    got = {r.doc_id: tuple(r[1:]) for r in suffix_dedup.repeat_report(frame(spark, rows)).collect()}
    assert got == suffix_dedup.brute_force(rows)


def test_drop_repeats_keeps_columns_and_white_space(spark):
    rows = [(1, f" \n first  part {PASSAGE}\n\nand  more "), (2, f"  b {PASSAGE}  after \t it\n"),
            (3, None), (4, f"{PASSAGE}"), (5, "  ")]
    df = frame(spark, rows)
    out = suffix_dedup.drop_repeats(df)
    assert out.columns == df.columns and out.schema == df.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[1] == (rows[0][1], len(rows[0][1]))
    assert got[2] == ("  b after \t it\n", 15) and got[3] == (None, None)
    assert got[4] == ("", 0) and got[5] == ("  ", 2)


@pytest.mark.parametrize("source", ["awkward", "data"])
def test_fuzzy_lines(spark, source):
    df = frame(spark, awkward()) if source == "awkward" else docs_of(spark)
    if source == "data":
        df = df.where("doc_id < 120")
    pairs = [(d, t) for d, t in _fill(pairs_of(df)) if d != BIG]
    want = line_dedup.brute_force(sorted(set(pairs)))
    got = {r.doc_id: r.kept_sha256 for r in line_dedup.line_report(df).collect()
           if r.doc_id is not None}
    wrong = [d for d in want if got[d] != line_dedup.digest(want[d])]
    # banding may miss a pair near the threshold with probability 0.005
    assert len(wrong) <= (0 if source == "awkward" else 2), wrong


def test_drop_lines_keeps_columns_and_rows(spark):
    rows = [(1, LINE + "\nshort"), (2, "own line that nobody else has\n" + LINE + "\nshort"),
            (3, None), (4, ""), (4, ""), (None, LINE)]
    df = frame(spark, rows)
    out = line_dedup.drop_lines(df, short_copies=False)
    assert out.schema == df.schema
    got = sorted(((r.doc_id or 99), r.text, r.n_chars) for r in out.collect() if r.text is not None)
    assert got == [(1, LINE + "\nshort", len(LINE) + 6),
                   (2, "own line that nobody else has\nshort", 35),
                   (4, "", 0), (4, "", 0), (99, "", 0)]
    assert out.count() == 6


def test_candidates_cover_buckets_over_batches_and_partitions(spark):
    import pyarrow as pa
    import numpy as np
    band = np.sort(np.repeat(np.arange(30), [1, 2, 3] * 10))
    line = np.arange(len(band)) * 7
    parts = [pa.RecordBatch.from_arrays([pa.array(band[i:i + 4]), pa.array(line[i:i + 4])],
                                        names=["band", "line"]) for i in range(0, len(band), 4)]
    out = [r for b in line_dedup._candidates(iter(parts)) for r in b.to_pylist()]
    got = {(r["a"], r["b"]) for r in out if not r["edge"]}
    want = {(int(x), int(y)) for i, x in enumerate(line) for j, y in enumerate(line)
            if i < j and band[i] == band[j]}
    assert got == want
    assert [r["band"] for r in out if r["edge"]] == [0, 29]


def test_copies_of_short_lines_go(spark):
    rows = [(1, "And so.\n漢字\nx\n\nAnd so."), (2, " And so. \n漢字\n\nown"), (3, "x"), (3, "x"),
            (None, "And so!\nx"), (4, LINE + "\nAnd so.\nnineteen bytes here")]
    want = {1: "And so.\n漢字\nx\n", 2: "\nown", 3: "", None: "And so!",
            4: LINE + "\nnineteen bytes here"}
    df = frame(spark, rows)
    got = line_dedup.line_report(df).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.kept_sha256 for r in got} == {d: line_dedup.digest(t)
                                                      for d, t in want.items()}
    out = line_dedup.drop_lines(df).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in out} == {(d, t, len(t)) for d, t in want.items()}


def _family(n, seed=3):
    """``n`` lines of one template: pairs with nearly the same field (0.86), others at about 0.75."""
    import random
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    template = " ".join(word(6) for _ in range(30))
    out = []
    for _ in range(n // 2):
        field = word(14)
        out += [f"{template}{field}{word(18)}", f"{template}{field}{word(18)}"]
    return out


def test_fuzzy_lines_of_one_template(spark):
    lines = _family(400)
    sets = [line_dedup.shingles(x.encode()) for x in lines]
    want = {(i, j) for j in range(len(lines)) for i in range(j)
            if line_dedup.jaccard(sets[i], sets[j]) >= line_dedup.SIMILARITY}
    assert want == {(i, i + 1) for i in range(0, len(lines), 2)}
    df = frame(spark, list(enumerate(lines)))
    removed = {r.doc_id for r in line_dedup.line_report(df).collect() if r.n_removed}
    # banding alone misses about one pair in a thousand at 0.86
    assert removed <= {j for _, j in want} and len(removed) >= len(want) - 1


SCRIPTS = ["abcdefghijklmnop qrst", "漢字語文書本日月火水木金土人大小中上下左右", "aé漢😀 bßяЖد"]


@pytest.mark.parametrize("alphabet", SCRIPTS)
def test_fuzzy_lines_of_every_script(spark, alphabet):
    import random
    rng = random.Random(len(alphabet))
    lines = ["".join(rng.choices(alphabet, k=k)).strip() + "x" * 3 for k in
             [17, 19, 30, 47, 60, 60, 90, 200]]
    for base in list(lines):
        for _ in range(3):      # one inner character changed, or the last one
            at = rng.randrange(8, len(base) - 8)
            lines += [base[:at] + "Z" + base[at + 1:], base[:-1] + rng.choice("uvw")]
    rows = [(i, x + "\n" + rng.choice(lines)) for i, x in enumerate(lines)]
    got = {r.doc_id: r.kept_sha256 for r in line_dedup.line_report(frame(spark, rows)).collect()}
    want = {d: line_dedup.digest(t) for d, t in line_dedup.brute_force(rows).items()}
    assert sum(got[d] != want[d] for d in want) == 0


def test_smallest_line_that_survives_an_inner_edit():
    letters = [chr(0x4E00 + i) for i in range(100)]
    for n, similar in ((78, False), (79, True)):
        line = "".join(letters[:n])
        edit = line[:30] + "x" + line[31:]
        j = line_dedup.jaccard(line_dedup.shingles(line.encode()), line_dedup.shingles(edit.encode()))
        assert (j >= line_dedup.SIMILARITY) == similar


def test_sketches_rule_out_no_similar_pair():
    import random
    import numpy as np
    rng = random.Random(9)
    ruled_out = 0
    for k in range(300):
        a = "".join(rng.choices("abcé漢 ", k=rng.randrange(20, 600)))
        b = list(a)
        for _ in range(rng.randrange(1 + len(a) // 8)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        pair = [a.encode(), "".join(b).encode()]
        bits, n = line_dedup.sketches(pair)
        differ = int(np.bitwise_count((bits[0] ^ bits[1]).view(np.uint64)).sum())
        ok = differ <= (1 - 0.8) / (1 + 0.8) * n.sum() + 1e-6
        ruled_out += not ok
        assert ok or line_dedup.jaccard(*map(line_dedup.shingles, pair)) < 0.8
    assert ruled_out > 50


def test_marks_rule_out_no_similar_pair():
    import random
    rng = random.Random(11)
    a, b = [b"x" * 20, b"ab" * 15, b"x" * 20], [b"x" * 9000, b"ab" * 400, b"y" * 20]
    for _ in range(600):
        x = "".join(rng.choices("abcé漢 ", k=rng.randrange(20, 900)))
        y = list(x)
        for _ in range(rng.randrange(1 + len(x) // 16)):
            y[rng.randrange(len(y))] = rng.choice("xyz")
        a.append(x.encode())
        b.append("".join(y).encode())
    may = line_dedup.may_be_similar(a, b)
    near = [line_dedup.jaccard(*map(line_dedup.shingles, p)) >= 0.8 for p in zip(a, b, strict=True)]
    assert near[:3] == [True, True, False]
    assert all(m for m, n in zip(may, near, strict=True) if n)
    assert sum(near) > 50 and (~may).sum() > 50


def test_crowded_pairs_miss_no_similar_pair(spark, monkeypatch):
    import random
    rng = random.Random(5)
    monkeypatch.setattr(line_dedup, "CELL", 16)
    lines = _family(60) + ["ab" * n for n in range(10, 40)] + ["x" * n for n in (20, 30)]
    base = "".join(rng.choice("abcdefgh ") for _ in range(300))
    for _ in range(120):
        x = list(base[rng.randint(0, 40):rng.randint(200, 300)])
        for _ in range(rng.randint(0, 4)):
            x[rng.randrange(len(x))] = rng.choice("xyz")
        lines.append("".join(x))
    bodies = sorted({x.encode() for x in lines})
    sets = [line_dedup.shingles(x) for x in bodies]
    for classes in (len(bodies), 7):
        want = {(i, j) for j in range(len(bodies)) for i in range(j) if i % classes != j % classes
                and line_dedup.jaccard(sets[i], sets[j]) >= line_dedup.SIMILARITY}
        df = spark.createDataFrame([(i, bytearray(x), i % classes) for i, x in enumerate(bodies)],
                                   "line long, body binary, component long").repartition(5)
        pairs = line_dedup.crowded_pairs(df)
        got = {tuple(r) for r in line_dedup._verified(pairs, df).collect()}
        assert want and got == want


def test_candidates_name_the_lines_of_large_buckets():
    import pyarrow as pa
    band = [1] * 4 + [2] * 5 + [3] + [4] * 23 + [5] * 4
    for step in (1, 3, 4, 100):
        parts = [pa.RecordBatch.from_arrays(
            [pa.array(band[i:i + step], pa.int64()),
             pa.array(range(i, min(i + step, len(band))), pa.int64())], names=["band", "line"])
            for i in range(0, len(band), step)]
        out = [r for b in line_dedup._candidates(iter(parts)) for r in b.to_pylist()]
        got = {r["a"] for r in out if not r["edge"] and r["a"] == r["b"]}
        assert got == {i for i, b in enumerate(band) if b in (2, 4)}


def _batches(rows, step, names):
    import pyarrow as pa
    return iter([pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i:i + step]])
                 for i in range(0, len(rows), step)])


def test_large_buckets_are_dealt_out_and_hang_together(monkeypatch):
    import numpy as np
    monkeypatch.setattr(line_dedup, "CELL", 20)
    keys = np.array([[7, 100 + i // 3, 10**6 + i] for i in range(300)], np.int64)
    bands, lines = line_dedup._bucket_rows(np.arange(300), keys)
    assert (bands[1:] >= bands[:-1]).all()
    buckets = defaultdict(set)
    for b, x in zip(bands.tolist(), lines.tolist(), strict=True):
        buckets[b].add(x)
    few = line_dedup.ALL_PAIRS + 1
    assert len(buckets[7]) == few and max(map(len, buckets.values())) == 20 + few
    assert [buckets[100 + k] for k in range(100)] == [{3 * k, 3 * k + 1, 3 * k + 2} for k in range(100)]
    large = [b for b in buckets.values() if len(b) >= few]
    assert set().union(*large) == set(range(300)) and all(buckets[7] <= b for b in large)


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_packed_rows_give_every_candidate(monkeypatch, step):
    monkeypatch.setattr(line_dedup, "CHUNK_LINES", 40)
    monkeypatch.setattr(line_dedup, "BUCKET_BYTES", 500)
    texts = [(f"{LINE} number {i // 2} of {'both' if i % 2 else 'some'}\n{LINE}\n"
              + " ".join(f"own{i}x{k}" for k in range(9)),) for i in range(90)]
    every = sorted({x for t, in texts for x in t.split("\n")})
    ids = [line_dedup.line_id(x.encode()) for x in every]
    buckets = defaultdict(set)
    for i, keys in zip(ids, line_dedup.band_keys([x.encode() for x in every]).tolist(), strict=True):
        for k in keys:
            buckets[k].add(i)
    packed = [(r["part"], r["rows"]) for b in line_dedup._signatures(10)(_batches(texts, step, ["text"]))
              for r in b.to_pylist()]
    # rows for each part and chunk, not for each line and band
    assert len(packed) < len(ids) * line_dedup.BANDS and all(0 <= p < 1024 for p, _ in packed)
    got = {(r["a"], r["b"]) for b in line_dedup._bucket_pairs(
        _batches(sorted(packed), step, ["part", "rows"])) for r in b.to_pylist()}
    crowded = {a for a, b in got if a == b}
    large = [b for b in buckets.values() if len(b) > line_dedup.ALL_PAIRS]
    assert large and crowded == set().union(*large)
    small = {(a, b) for x in buckets.values() if 1 < len(x) <= line_dedup.ALL_PAIRS
             for a in x for b in x if a < b}
    assert small <= got


def test_bodies_of_lines_without_a_candidate_are_left_out(spark):
    bodies = [f"line {i} has words and a number {i * i}" for i in range(2000)]
    ids = [line_dedup.line_id(x.encode()) for x in bodies]
    marked = line_dedup._marked(spark.createDataFrame([(x,) for x in ids[:50]], "line long"))
    out = [r for b in line_dedup._texts(marked)(_batches([(x,) for x in bodies], 100, ["text"]))
           for r in b.to_pylist()]
    assert {r["line"]: r["body"].decode() for r in out}.items() >= dict(
        zip(ids[:50], bodies[:50], strict=True)).items()
    assert all(bodies[ids.index(r["line"])] == r["body"].decode() for r in out)
    assert len(out) < 500


def test_empty_tables(spark):
    df = empty(spark)
    for f in (content_dedup.exact_groups, simhash.near_groups, suffix_dedup.repeat_report,
              suffix_dedup.drop_repeats, line_dedup.line_report, line_dedup.drop_lines):
        out = f(df)
        assert out.columns and out.count() == 0
