import pytest

from quire.llm.mixing import mix, mix_report
from tests.llm.fixtures import clashing, documents, frame


def water(sizes: dict, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped = {s for s in order if sizes[s] == 0}
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: most * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_equal_iterated_resharing(spark):
    docs = documents(2, 80) + [(500 + i, "one two three", "en", f"t{i}", 0) for i in range(7)]
    rows = mix_report(frame(spark, docs)).collect()
    sizes: dict = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + len((d[1] or "").split())
    want = water(sizes)
    assert len(rows) == len(docs)
    by = {(r["doc_id"], r["size"]): r for r in rows}
    for d in docs:
        r = by[d[0], len((d[1] or "").split())]
        assert r["source_size"] == sizes[d[3]] and r["target"] == pytest.approx(want[d[3]])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        rate = want[d[3]] / sizes[d[3]] if sizes[d[3]] else 0
        assert int(rate) <= r["copies"] <= int(rate) + 1


def test_near_target_and_repeatable(spark):
    docs = [(i, "w " * (1 + i % 9), "en", "abc"[i % 3], 0) for i in range(3000)]
    df = frame(spark, docs)
    first, again = (sorted(map(tuple, mix_report(x).collect())) for x in (df, df.repartition(7)))
    assert first == again
    for s in "abc":
        own = [r for r in mix_report(df).collect() if docs[r["doc_id"]][3] == s]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.05)


def test_mix_emits_whole_rows(spark):
    df = clashing(frame(spark, documents(2, 40)))
    copies = {(r["doc_id"], r["size"]): r["copies"] for r in mix_report(df.select("doc_id", "text", "source")).collect()}
    out = mix(df)
    assert out.columns == df.columns
    got: dict = {}
    for r in out.collect():
        key = r[0], len((r[1] or "").split())
        got[key] = got.get(key, 0) + 1
    times = {k: v * (3 if k[0] == 3 else 1) for k, v in copies.items() if v}  # document 3 is there three times
    assert got == times


def test_empty_table(spark):
    assert mix_report(frame(spark, [])).count() == 0 and mix(frame(spark, [])).count() == 0
    only = frame(spark, [(1, None, None, None, 0), (2, "", "en", "a", 0)])
    assert [(r["target"], r["taken"]) for r in mix_report(only).collect()] == [(0.0, 0)] * 2
