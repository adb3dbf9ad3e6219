import collections
import hashlib
import random

import pytest

from quire.llm.line_align import aligned, dedupe_lines, line_report
from tests.llm.fixtures import EN, clashing, documents, frame, prose
from tests.llm.test_decontaminate import words


def rising(pairs):
    best = []
    for k, (_, b) in enumerate(pairs):
        best.append(1 + max([best[j] for j in range(k) if pairs[j][1] < b], default=0))
    return max(best, default=0)


def test_chain_is_longest_and_rises():
    rng = random.Random(1)
    for _ in range(300):
        other = rng.sample(range(50), rng.randint(0, 20))
        got = aligned(list(range(len(other))), other)
        assert [other[k] for k in got] == sorted(other[k] for k in got) and got == sorted(got)
        assert len(got) == rising(list(enumerate(other)))


def brute(rows):
    """{row: kept text} with first holders, overlap rule and blocks as in the docstring."""
    docs = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines, first, df = {}, {}, collections.Counter()
    for d in docs:
        seen, own = collections.Counter(), []
        for line in (d[1] or "").split("\n"):
            w = tuple(words(line))
            if w:
                own.append((w, seen[w]))
                seen[w] += 1
        lines[d] = own
        for p, k in enumerate(own):
            first.setdefault(k, (d, p))
    for r in rows:
        df.update(lines[r[0], r[1]])
    out = {}
    for d in docs:
        by = collections.defaultdict(list)
        for p, k in enumerate(lines[d]):
            if first[k][0] != d:
                by[first[k][0]].append((p, first[k][1], len(k[0]), df[k]))
        gone = set()
        for ps in by.values():
            if min(x[3] for x in ps) > 16 and len(ps) < 2 and ps[0][2] < 10:
                continue
            run = []
            for k in [*aligned([x[0] for x in ps], [x[1] for x in ps]), None]:
                if run and (k is None or (ps[k][0], ps[k][1]) != (run[-1][0] + 1, run[-1][1] + 1)):
                    if sum(x[2] for x in run) >= 10:
                        gone |= {x[0] for x in run}
                    run = []
                if k is not None:
                    run.append(ps[k])
        kept, at = [], -1
        for line in (d[1] or "").split("\n"):
            at += bool(words(line))
            if not words(line) or at not in gone:
                kept.append(line)
        out[d] = (None if d[1] is None else "\n".join(kept), len(lines[d]) - len(gone), len(gone))
    return out


def hard_rows():
    rng = random.Random(5)
    rows = documents(8, 25)
    shared = prose(rng, EN, 60)
    rows += [(300 + k, prose(rng, EN, 24) + "\n" + shared + "\n\n" + prose(rng, EN, 24), "en", "s", 0) for k in range(20)]
    license_line = "Licensed to everyone under no conditions at all."
    rows += [(400 + k, prose(rng, EN, 24) + "\n" + license_line, "en", "s", 0) for k in range(20)]
    rows += [(500, "same line here\n" * 30, "en", "s", 0), (501, "same line here\n" * 40, "en", "s", 0)]
    return rows


def test_report_equals_brute_force(spark):
    rows = hard_rows()
    want = brute(rows)
    got = line_report(frame(spark, rows)).collect()
    own = [(str(r[0]), *want[r[0], r[1]][1:], None if r[1] is None else hashlib.sha256(want[r[0], r[1]][0].encode()).hexdigest()) for r in rows]
    assert sorted(map(str, ((str(r["doc_id"]), r["n_lines"], r["n_gone"], r["text_sha256"]) for r in got))) == sorted(map(str, own))
    assert sum(r["n_gone"] for r in got) > 50
    assert all(r["n_gone"] == 0 for r in got if r["doc_id"] is not None and 400 <= r["doc_id"] < 420)  # one short frequent line is no overlap


def all_pairs(texts):
    """Lines each text loses when it is aligned with every earlier one."""
    gone = []
    for d, own in enumerate(texts):
        lost = set()
        for other in texts[:d]:
            at = {k: p for p, k in enumerate(other)}
            ps = [(p, at[k], len(k.split())) for p, k in enumerate(own) if k in at]
            run = []
            for k in [*aligned([x[0] for x in ps], [x[1] for x in ps]), None]:
                if run and (k is None or (ps[k][0], ps[k][1]) != (run[-1][0] + 1, run[-1][1] + 1)):
                    if sum(x[2] for x in run) >= 10:
                        lost |= {x[0] for x in run}
                    run = []
                if k is not None:
                    run.append(ps[k])
        gone.append(len(lost))
    return gone


def test_passages_whose_lines_were_seen_apart(spark):
    rng = random.Random(8)
    line = [" ".join(f"l{k}w{j}" for j in range(rng.choice([2, 3, 6, 9, 12]))) for k in range(30)]
    line = [x if len(x.split()) < 10 or k % 3 else x + " more" for k, x in enumerate(line)]
    texts = [[f"own {k} begin", x, f"own {k} end"] for k, x in enumerate(line) if len(x.split()) < 10]  # every short line is first seen alone
    for k in range(40):  # passages from 2 to 7 lines, in the order of the lines
        a, n = rng.randrange(24), rng.randint(2, 7)
        texts.append([f"head of {k}", *line[a:a + n], f"tail of {k}"])
    rows = [(k, "\n".join(t), "en", "s", 0) for k, t in enumerate(texts)]
    rows += [(1000, "one two three four five six", "en", "s", 0), (1001, "seven eight nine ten eleven twelve", "en", "s", 0)]
    rows += [(k, "one two three four five six\nseven eight nine ten eleven twelve", "en", "s", 0) for k in (1002, 1003)]
    got = {r["doc_id"]: r["n_gone"] for r in line_report(frame(spark, rows)).collect()}
    assert [got[k] for k in range(len(texts))] == all_pairs(texts)
    assert [got[k] for k in range(1000, 1004)] == [0, 0, 0, 2]


@pytest.mark.parametrize("holders", [16, 17, 400])
def test_a_long_line_is_deleted_however_many_hold_it(spark, holders):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"own begin of {k}\n{passage}\nown end of {k}", "en", "s", 0) for k in range(holders)]
    got = {r["doc_id"]: r["n_gone"] for r in line_report(frame(spark, rows)).collect()}
    assert got == {k: int(k > 0) for k in range(holders)}


def test_other_columns_stay(spark):
    df = clashing(frame(spark, hard_rows()))
    out = dedupe_lines(df)
    assert out.columns == [*df.columns, "n_gone"] and out.count() == df.count()


def test_no_line_is_lost(spark):
    rows = hard_rows()
    left = {tuple(words(x)) for r in dedupe_lines(frame(spark, rows)).collect() for x in (r["text"] or "").split("\n")}
    assert {tuple(words(x)) for r in rows for x in (r[1] or "").split("\n")} - {()} <= left


def test_empty_table(spark):
    assert line_report(frame(spark, [])).count() == 0
