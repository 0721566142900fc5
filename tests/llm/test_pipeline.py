"""The corpus pipeline, stage by stage, against brute force."""

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
from strata.llm import line_dedup, simhash, suffix_dedup
from strata.llm.tokens import byte_bpe
from tests.llm.helpers import LINE, PASSAGE, SF, docs_of

BIG = 2**63 - 1


def _nearest(texts):
    """The component of each text."""
    fps = {t: int(simhash.fingerprints_of([(t or "").encode()], 3)[0]) for t in texts}
    root = {v: v for v in fps.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {t: find(v) for t, v in fps.items()}


def _check_one_of_each(rows, kept):
    """``kept`` has one of ``rows`` of each component, with its smallest id."""
    assert not Counter(kept) - Counter(rows)
    component = _nearest({t for _, t in rows})
    least = {}
    for d, t in rows:
        c = component[t]
        least[c] = min(least.get(c, BIG), BIG if d is None else d)
    assert sorted((component[t], BIG if d is None else d) for d, t in kept) == sorted(least.items())


def test_near_duplicates_keep_one_row_of_each_component(spark):
    other = " ".join(f"other{i}" for i in range(50))
    third = " ".join(f"third{i}" for i in range(50))
    rows = [(None, PASSAGE), (None, PASSAGE), (None, other), (5, other), (7, third), (7, third),
            (7, LINE), (8, LINE), (None, None), (None, "")]
    df = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.near_duplicates(spark, df.repartition(4), "")
    assert out.schema == df.schema
    _check_one_of_each(rows, [(r.doc_id, r.text) for r in out.collect()])


def test_run_against_brute_force(spark, workdir, monkeypatch):
    data = docs_of(spark)
    some = data.where("doc_id < 100")
    first = some.orderBy("doc_id").limit(8)
    docs = (some.union(first)                                           # repeated rows
            .union(first.selectExpr("doc_id + 100000", *data.columns[1:]))      # copies
            .union(first.selectExpr("cast(null as long)", *data.columns[1:])))  # no ids
    docs.toDF(*data.columns).write.parquet(f"{workdir}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{workdir}/labels.parquet")
    seen, write = {}, corpus_pipeline.written

    def keep(df, label):
        out = write(df, label)
        seen[label] = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
        return out

    monkeypatch.setattr(corpus_pipeline, "written", keep)
    pieces = corpus_pipeline.run(spark, workdir).collect()
    given = [(r.doc_id, r.text) for r in docs.collect()]
    good, lines, near, last = (seen[f"pipeline-{n}"] for n, _ in corpus_pipeline.STAGES[:-1])

    fate = defaultdict(set)     # the classifier sees the text alone: equal texts share a fate
    for row, n in Counter(given).items():
        assert Counter(good)[row] in (0, n)
        fate[row[1]].add(Counter(good)[row] > 0)
    assert good and all(len(x) == 1 for x in fate.values())

    # rows without id come last; one of them per text, so that ids tell texts apart
    names = {row: k for k, row in enumerate(sorted(set(good), key=lambda r: (
        BIG if r[0] is None else r[0], spark_hash(spark, r[1]))))}
    want = line_dedup.brute_force([(k, t) for (_, t), k in names.items()])
    wrong = Counter((d, want[names[d, t]]) for d, t in good) - Counter(lines)
    assert wrong.total() <= 2       # banding may miss a pair near the threshold

    _check_one_of_each(lines, near)

    ids = [d for d, _ in near if d is not None]
    assert len(ids) == len(set(ids)) and len(near) - len(ids) <= 1
    kept = suffix_dedup.brute_force([(BIG if d is None else d, t) for d, t in near])
    assert len(last) == len(near)
    for d, t in last:
        sha = hashlib.sha256(b" ".join(t.encode().split())).hexdigest()
        assert sha == kept[BIG if d is None else d][2]

    packed = Counter()
    for r in pieces:
        packed[r.doc_id] += r.length
    assert packed == Counter({d: len(byte_bpe().encode(t)) + 1 for d, t in last})


def spark_hash(spark, text):
    """xxhash64 of a text as Spark has it: the order of lines in rows that share an id."""
    from pyspark.sql import functions as F
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
