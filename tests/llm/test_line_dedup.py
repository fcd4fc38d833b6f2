import random
import re

from pyspark.sql import functions as F

from metroflux.llm.line_dedup import drop_repeated_lines


def brute(rows, m, words=20, whole=True):
    """Texts after the later copies of repeated runs are cut: m lines, or fewer with enough words, or a whole text of fewer lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    count = lambda lines: sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines)
    seen, gone = set(), [set() for _ in rows]
    for i in order:
        lines = rows[i][1].split("\n") if rows[i][1] is not None else []
        runs = [(a, n, tuple(lines[a:a + n])) for n in range(1, m + 1) for a in range(len(lines) - n + 1) if n == m or count(lines[a:a + n]) >= words]
        if whole and len(lines) < m and count(lines):
            runs.append((0, len(lines), ("whole", *lines)))
        for a, n, w in runs:
            if w in seen:
                gone[i].update(range(a, a + n))
            seen.add(w)
    return [(d, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]))
            for i, (d, t) in enumerate(rows)]


def corpus(seed):
    rng = random.Random(seed)
    runs = [[f"line {rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 9))] for _ in range(12)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(runs) if rng.random() < 0.5 else [f"own {rng.randrange(10 ** 6)}", "", "The end."][:rng.randint(1, 3)]
        rows.append((i, "\n".join(lines)))
    long = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (4, 12, 19, 20, 21, 60)]
    rows += [(200 + i, "\n".join(rng.choices(long, k=rng.randint(1, 3)) + [f"own {i}"] * rng.randint(0, 2))) for i in range(60)]
    rows += [(300 + i, "\n".join(long[i % 3:i % 3 + 1 + i % 2])) for i in range(12)]
    return rows + [(100, rows[3][1]), (101, None), (102, ""), (103, "\n\n\n\n\n"), (None, "a\nb\nc"), (104, "a\nb\nc"), (105, "x\r\ny\nz")]


def test_equals_brute_force(frame):
    for seed, m in ((1, 3), (2, 2), (3, 1), (4, 5), (5, 9)):
        rows = corpus(seed)
        out = drop_repeated_lines(frame(rows), m)
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(brute(rows, m), key=str)
        assert {"row", "runs", "name", "line"} <= set(out.columns)


def test_runs_are_maximal_and_copies_lose_all(frame):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb\nc\nd\ne"), (4, "b\nc"), (5, "z\nb\nc")]
    out = {r.doc_id: r for r in drop_repeated_lines(frame(rows, clash=False), 3, with_runs=True).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "x\ny" and out[3].text == "" and out[4].text == "b\nc"
    assert [tuple(r) for r in out[2].runs] == [(1, 4)] and [tuple(r) for r in out[3].runs] == [(0, 4)]


def test_repeats_within_a_text_and_shared_ids(frame):
    out = drop_repeated_lines(frame([(1, "a\nb\nc\na\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc")]), 3)
    texts = sorted(r.text for r in out.collect())
    assert texts.count("") >= 1 and "".join(texts).replace("\n", "") == "abc"


def test_long_lines_and_short_copies_go_too(frame):
    passage = " ".join(f"word{i}" for i in range(55))
    rows = [(1, f"x\n{passage}\ny"), (2, f"{passage}\nown"), (3, "a short text"), (4, "a short text"), (5, "a short text\nmore"), (6, ""), (7, "")]
    out = {r.doc_id: r.text for r in drop_repeated_lines(frame(rows)).collect()}
    assert out == {1: rows[0][1], 2: "own", 3: "a short text", 4: "", 5: "a short text\nmore", 6: "", 7: ""}


def test_empty_table(frame):
    assert drop_repeated_lines(frame([])).count() == 0


def test_no_python_and_no_cross_join(frame):
    plan = drop_repeated_lines(frame(corpus(1)).withColumn("z", F.lit(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
