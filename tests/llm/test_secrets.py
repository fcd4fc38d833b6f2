import random
import re

from pyspark.sql import functions as F

from metroflux.llm import secrets as S


def rows():
    rng = random.Random(2)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    out = []
    for i in range(60):
        out.append((i, f'some words here\nthen token = "{hexes()}" and more\npay 4{rng.randrange(10 ** 14, 10 ** 15)} now'))
        out.append((100 + i, f"see /usr/lib/pkg{rng.randrange(10 ** 9)}/file{i}_module_{i} and commit {hexes()} again"))
    return out + [(300, None), (301, ""), (302, "no candidate in here"), (None, f'api_key = "{hexes()}"'), (303, "x" * 50), (304, f"a{hexes()} b{hexes()}")]


def test_candidates_and_places(frame):
    data = rows()
    got = S.candidates(frame(data)).collect()
    want = []
    for d, t in data:
        for n, line in enumerate((t or "").split("\n")):
            want += [(d, n, m.start(), m.group()) for m in re.finditer(S.CANDIDATE, line)]
    assert sorted(((r.doc_id, r.line, r.start, r.finding) for r in got), key=str) == sorted(want, key=str)


def test_forest_removes_false_positives(frame):
    out = S.scan(frame(rows())).collect()
    by = {(r.doc_id, r.finding): r for r in out}
    true = [r for r in out if r.doc_id is not None and r.doc_id < 60 and len(r.finding) == 40]
    false = [r for r in out if r.doc_id is not None and (100 <= r.doc_id < 200 or (r.doc_id < 60 and len(r.finding) == 16))]
    assert len(by) == len(out) and all(r.is_secret for r in true) and not any(r.is_secret for r in false)


def test_given_labels_rule_and_small_tables(spark, frame):
    df = frame(rows())
    found = S.candidates(df).withColumn("finding_no", F.xxhash64("doc_id", "line", "start", "finding"))
    labels = found.select("finding_no", F.col("finding").startswith("/").cast("double").alias("label"))
    out = S.scan(df, labels).collect()
    assert all(r.is_secret == r.finding.startswith("/") for r in out)
    assert S.scan(frame([])).count() == 0
    assert S.scan(frame([(1, "nothing")])).count() == 0
    one = S.scan(frame([(1, f"commit {'ab12' * 10}"), (1, f"commit {'ab12' * 10}")])).collect()
    assert len(one) == 2 and not any(r.is_secret for r in one)


def test_texts_are_read_for_the_words_and_once_for_the_findings(spark, frame):
    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda text: read.add(1) or text, "string").asNondeterministic()
    out = S.scan(frame(rows()).withColumn("text", counted("text"))).collect()
    assert read.value == 2 * len(rows()) and out


def test_no_python_in_the_plan(frame):
    plan = S.scan(frame(rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_secrets_of_other_shapes_are_found(frame):
    rng = random.Random(6)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    data, want, plain = rows(), set(), set()
    for i in range(40):
        made = [(f"export AWS_SECRET_ACCESS_KEY={(k := key(20) + '/' + key(19))}", k),
                (f"see http://host.example/a?user=me&token={(k := 'Z9' + key(28))}&x=1", k),
                (f'use "{(k := "eyJ" + key(20) + "." + key(30) + "." + key(30))}" here', k),
                (f"password: {(k := 'hu9' + key(5))}", k),
                (f"sent with {(k := 'ghp_' + key(36))} to all", k),
                (f"Authorization: Bearer {(k := 'Q1' + key(30))}", k)]
        for j, (line, k) in enumerate(made):
            data.append((1000 + 10 * i + j, line))
            want.add((1000 + 10 * i + j, k))
        data.append((3000 + i, f"md5 {key(32).lower()}1 and AB{i}_WITH_A_LONG_NAME_1=on"))
    # no digit, and no name before it
    data.append((4000, "key abcdefGHIJKLmnopqrSTUV"))
    out = S.scan(frame(data)).collect()
    secret = {(r.doc_id, r.finding) for r in out if r.is_secret}
    assert want <= secret
    assert not [x for x in secret if x[0] is not None and 3000 <= x[0] < 4000]
    assert (4000, "abcdefGHIJKLmnopqrSTUV") in {(r.doc_id, r.finding) for r in out}
