import hashlib
import random
import re

from pyspark.sql import functions as F

from fascicle.llm import document_sketch as ds
from fascicle.session import load

PIECES = re.compile(r"[^\x20\x09-\x0D]{1,40}(?:[\x20\x09]+[^\x20\x09-\x0D]{1,40}){0,7}")


def pieces(text):
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in PIECES.findall(text or "")}


def likeness(a, b):
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def cells_of(found):
    out = [[0, 0, 0] for _ in range(24)]
    a, b, c = ds.CHECK
    for d in found:
        for t, p in enumerate(ds.PRIMES):
            cell = out[8 * t + d % p % 8]
            cell[0] += 1
            cell[1] ^= d
            cell[2] ^= (d % a) * (d % b) % c
    return "-".join(f"{c:x}.{k:x}.{h:x}" for c, k, h in out)


def test_query_on_odd_rows(spark):
    random.seed(11)
    words = ["un", "deux", "é", "😀", "ten\nlines", "x" * 95, "tab\tbed", "."]
    rows = [(k, " ".join(random.choices(words, k=random.choice([0, 1, 3, 20, 200])))) for k in range(60)]
    rows += [(None, "no id at all"), (100, None), (101, ""), (102, " \n "), (103, "long " * 30_000 + "tail"), (104, " ".join(f"w{k}" for k in range(9000)))]
    rows += [(200 + k, "the same text " * 50) for k in range(5)] + [(3, rows[3][1])] * 3
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fingerprint string, k1 int")
    order = sorted({(d is not None, d or 0): (d, t or "") for d, t in rows}.items())
    texts = [v for _, v in order]
    want = {}
    for k, (d, t) in enumerate(texts):
        after, need = texts[(k + 1) % len(texts)][1], len(t) // 4
        edited = t[:len(t) - need] + after[:need]
        a, e = pieces(t), pieces(edited)
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), cells_of(a), cells_of(e), likeness(a, e), likeness(a, pieces(after)))
    found = ds.edited_likeness(df).collect()
    assert sorted((repr(r.doc_id) for r in found)) == sorted(repr(d) for d, _ in rows)
    for r in found:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_one_and_no_document(spark):
    one = ds.edited_likeness(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest() and one.near_next == 1.0
    assert ds.edited_likeness(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_changed_paragraphs(spark):
    random.seed(5)
    lines = [f"paragraph number {k} of the whole" for k in range(4000)]
    rows = [(k, "\n".join(random.sample(lines, n)), "\n".join(random.sample(lines, m))) for k, (n, m) in enumerate([(0, 0), (1, 1), (5, 6), (300, 300), (4000, 3990), (2000, 1)])] + [(9, None, "a\nb"), (9, "a\nb", "b\na")]
    found = {}
    for r in ds.changed_paragraphs(spark.createDataFrame(rows, "id long, before string, after string"), ["id"]).collect():
        found.setdefault(r.id, set()).add((r.digest, r.side))
    for k, a, b in rows[:6]:
        assert found.get(k, set()) == {(d, -1) for d in pieces(a) - pieces(b)} | {(d, 1) for d in pieces(b) - pieces(a)}
    assert found[9] == {(d, 1) for d in pieces("a\nb")}


def test_fingerprints_fail_and_larger_sketches_do_not(spark):
    sets = spark.range(40).selectExpr("id AS k1", "id AS k2", "0 AS pair", "transform(sequence(1L, 30L), i -> abs(xxhash64(id, i)) % 1000000000000000) AS a", "cast(array() AS array<bigint>) AS b").repartition("k1", "k2")
    first = ds.sketched(sets, ["a", "b"]).selectExpr(f"{ds.peeled(ds.subtracted('a', 'b'))} AS f")
    assert first.where("f IS NULL").count() == 40
    cells = ds.retried(sets)
    found = {(r.k1, r.k) for r in cells.where("found AND c = 1").collect()}
    failed = {r.k1 for r in cells.where("NOT found").collect()}
    assert len(failed) < 5 and {x for x in found if x[0] not in failed} == {(r.k1, k) for r in sets.collect() if r.k1 not in failed for k in r.a}


def test_one_shuffle_of_texts(spark, small):
    """Cells stay where their document is: no exchange is keyed by cell."""
    rows = ds.texts(load(spark, small, "documents"), "doc_id").withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64("doc_id")})
    found = ds._compared(rows, ds._links(rows), 0)
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "slot" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
