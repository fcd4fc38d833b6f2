import random
import re

from metroflux.llm.substring_dedup import repeated_units


def brute(rows, least):
    out, seen = [], {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        d, text = rows[i]
        if not text:
            continue
        cuts = [0] + [m.end() for m in re.finditer(r"\n|[.!?](?=[ \t-\r])", text)] + [len(text)]
        for a, b in zip(cuts, cuts[1:]):
            words = [m for m in re.finditer(r"[A-Za-z0-9\x80-\U0010ffff]+", text[a:b])]
            if len(words) < least:
                continue
            key = tuple(re.sub("[A-Z]", lambda m: m.group().lower(), w.group()) for w in words)
            start, end = a + words[0].start(), a + len(text[a:b].rstrip(" \t\n\r\x0b\x0c"))
            if key in seen:
                out.append((d, start, end, len(words), *seen[key]))
            else:
                seen[key] = (d, start)
    return sorted(out, key=str)


def test_equals_brute_force(frame):
    rng = random.Random(4)
    pool = [" ".join(rng.choice(["één", "two", "Three", "fo-ur", "5"]) for _ in range(rng.randint(1, 7))) for _ in range(40)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(pool) + rng.choice([". ", "\n", "! ", ".\n", "?", " "]) for _ in range(rng.randint(0, 8)))
        rows.append((i, rng.choice([text, text.upper().replace("É", "é"), "  " + text])))
    rows += [(200, None), (201, ""), (202, " \n\n. . !"), (None, rows[5][1]), (203, rows[5][1])]
    out = repeated_units(frame(rows), 3).collect()
    got = sorted(((r.doc_id, r.start, r.end, r.words, r.kept_doc_id, r.kept_start) for r in out), key=str)
    assert got == brute(rows, 3)
    texts = dict(r for r in rows if r[0] is not None)
    for r in out:
        if r.doc_id is not None:
            assert texts[r.doc_id][r.start:r.end].strip() == texts[r.doc_id][r.start:r.end]


def test_passage_inside_other_lines_is_found(frame):
    passage = "first part of it. " + " ".join(f"word{i}" for i in range(12)) + ". " + " ".join(f"more{i}" for i in range(12)) + ". and so"
    rows = [(1, "alpha beta " + passage + " gamma"), (2, "delta " + passage + " epsilon zeta"), (3, "nothing of this kind is in here at all, no")]
    out = repeated_units(frame(rows)).collect()
    assert {r.doc_id for r in out} == {2} and len(out) == 2 and {r.kept_doc_id for r in out} == {1}


def test_rows_of_one_id_and_empty(frame):
    text = "one two three four five six seven eight nine"
    assert repeated_units(frame([(1, text), (1, text), (1, text)])).count() == 2
    assert repeated_units(frame([])).count() == 0


def test_passages_of_short_sentences_go_as_one(frame):
    talk = "Who is there? Only me. Come in then. It is late. I know. Sit down."
    verse = "red as a rose\nblue as the sea\ngreen as a leaf"
    rows = [(1, f"Alpha one.\n{talk}\n\n{verse}\n\nend of one"), (2, f"{talk}\nother"), (3, f"x\n\n{verse}\n \ny"),
            (4, f"Alpha one.\n{talk}\n\n{verse}\n\nend of one"), (5, "Yes. No. I do.\nred as a rose"), (6, "\n" + talk + " More.")]
    texts = dict(rows)
    out = repeated_units(frame(rows), whole=True).collect()
    assert sorted((r.doc_id, texts[r.doc_id][r.start:r.end]) for r in out) == [(2, talk), (3, verse), (4, texts[4])]
    assert {r.kept_doc_id for r in out} == {1} and all(texts[1][r.kept_start:].startswith(texts[r.doc_id][r.start:r.end]) for r in out)
    assert not repeated_units(frame(rows)).collect()


def test_whole_units_take_at_least_what_sentences_take(frame):
    rng = random.Random(8)
    pool = [" ".join(rng.choice(["één", "two", "Three", "fo-ur", "5"]) for _ in range(rng.randint(1, 7))) for _ in range(30)]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([". ", "\n", "! ", ".\n", "\n\n", " \n \n"]) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(0, 150, 9)] + [(300, None), (301, "")]

    def places(out):
        spans = sorted((r.doc_id, r.start, r.end) for r in out)
        assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))
        return {(d, k) for d, a, b in spans for k in range(a, b)}

    big = repeated_units(frame(rows), 3, whole=True).collect()
    assert places(repeated_units(frame(rows), 3).collect()) < places(big)
    texts, copies = dict(rows), {r.doc_id: r for r in big if r.doc_id >= 200}
    for i in range(0, 150, 9):
        if len(re.findall(r"[\wé]+", texts[i])) >= 6:
            assert texts[200 + i][copies[200 + i].start:copies[200 + i].end] == texts[200 + i].strip()
