"""Line removal against a direct search of every pair of places."""

import random

from shelfcast.llm.line_dedup import SPACE, LineParams, cut_text, dedup_lines, line_count, lines_of

SCHEMA = "doc_id long, text string, lang string"


def expected(rows, min_words):
    """For each row, the numbers of the lines in runs that also start earlier."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    places = [(d, at) for d in order for at in range(len(lines_of(rows[d][1])))]
    lines = {i: lines_of(rows[i][1]) for i in order}
    gone = {i: set() for i in order}
    for n, (d, at) in enumerate(places):
        for e, before in places[:n]:
            if lines[d][at] != lines[e][before]:
                continue
            size = words = 0
            while (
                at + size < len(lines[d])
                and before + size < len(lines[e])
                and lines[d][at + size] == lines[e][before + size]
            ):
                words += len(lines[d][at + size].split())
                size += 1
            if words >= min_words:
                gone[d] |= set(range(at, at + size))
    return gone


def check(spark, rows, min_words):
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).coalesce(1)
    found = dedup_lines(docs, LineParams(min_words)).collect()
    gone = expected(rows, min_words)
    want = []
    for n, (i, text) in enumerate(rows):
        kept = [x for k, x in enumerate(lines_of(text)) if k not in gone[n]]
        want.append((i, kept, len(lines_of(text)), len(gone[n])))
    got = [(r.doc.doc_id, lines_of(r.text), r.n_lines, r.n_removed) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_random_texts_equal_a_direct_search(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lines = [rng.choice(["a b.", "c.", "d e f!", "g", "h i j k l m."]) for _ in range(rng.randint(0, 14))]
        rows.append((i, rng.choice(["\n", "\n\n"]).join(lines)))
    check(spark, rows, 7)
    check(spark, rows, 16)
    check(spark, rows, 1)


def test_a_passage_inside_a_line_is_found_and_clean_text_stays(spark):
    passage = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, f"Own start. {passage} own end."), (2, f"Other. {passage} Other end here."), (3, "Clean text.\nNext.")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], SCHEMA)
    texts = {r.doc.doc_id: r.text for r in dedup_lines(docs, LineParams()).collect()}
    assert texts == {1: rows[0][1], 2: "Other. Other end here.", 3: rows[2][1]}


def test_nulls_empty_repeated_long_and_extra_columns(spark):
    text = "\n".join(f"line number {i}" for i in range(3000))
    rows = [(None, None), (1, ""), (2, text), (2, text), (None, text), (4, "x " * 60), (4, "x " * 60)]
    docs = spark.createDataFrame([(i, t, n, n, "a") for n, (i, t) in enumerate(rows)], "doc_id long, text string, id int, row int, at string")
    found = dedup_lines(docs, LineParams()).collect()
    assert len(found) == 7 and set(found[0].doc.asDict()) == {"doc_id", "text", "id", "row", "at"}
    assert sorted(r.n_removed for r in found) == [0, 0, 0, 0, 1, 3000, 3000]
    assert [r.text for r in found if r.doc.id == 0] == [None]
    empty = dedup_lines(docs.limit(0), LineParams())
    assert empty.count() == 0 and empty.columns == ["doc", "text", "n_lines", "n_removed"]


def test_helpers():
    import numpy as np

    assert lines_of("A b. C d!  e\n\n 3.5 kg") == ["A b.", "C d!", "e", "3.5 kg"]
    assert cut_text("A b. C d! e", np.array([2]), np.array([2])) == ("A b. e", 3, 1)


def test_lines_are_counted_alike_with_and_without_python(spark):
    import numpy as np

    rng = random.Random(8)
    space = [chr(c) for c in np.flatnonzero(SPACE)]
    signs = [*"ab.!?", "\n", " ", "é", "😀", "\u200b", *rng.sample(space, len(space))]
    texts = [None, "", " ", "\n", ".", " . ", "a.", "a.\n", "\na \nb", "a. \n", "a b", "a.\u2003b", *space]
    texts += ["".join(rng.choice(signs[: rng.choice([7, 9, len(signs)])]) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    none = np.zeros(0, dtype=np.int64)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = dict(docs.select("i", line_count(docs.text)).collect())
    for i, text in enumerate(texts):
        assert found[i] == cut_text(text, none, none)[1] == len(lines_of(text)), repr(text)


def words_left(rows, min_words):
    """Each text's words that are in no run of min_words that also starts earlier, by all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, gone = set(), {i: set() for i in order}
    for i in order:
        words = (rows[i][1] or "").split()
        for at in range(len(words) - min_words + 1):
            window = tuple(words[at : at + min_words])
            gone[i] |= set(range(at, at + min_words)) if window in seen else set()
            seen.add(window)
    return [[w for n, w in enumerate((t or "").split()) if n not in gone[i]] for i, (_, t) in enumerate(rows)]


def test_passages_that_start_and_end_inside_sentences(spark):
    passage = " ".join(f"w{i}{'.' if i % 17 == 16 else ''}" for i in range(54))
    rows = [
        (1, f"First text with {passage} and on it goes. End."),
        (2, f"Quega esado en no {passage} then more words. Last."),
        (3, f"One line.\nAnother has {passage}\nThird line."),
        (4, " ".join(passage.split()[:49]) + " is too short."),
    ]
    docs = spark.createDataFrame([(*r, "en") for r in rows], SCHEMA)
    found = {r.doc.doc_id: r for r in dedup_lines(docs, LineParams()).collect()}
    assert {i: r.text for i, r in found.items()} == {
        1: rows[0][1],
        2: "Quega esado en no then more words. Last.",
        3: "One line.\nAnother has\nThird line.",
        4: rows[3][1],
    }
    assert [(found[i].n_lines, found[i].n_removed) for i in (1, 2, 3)] == [(5, 0), (5, 2), (6, 3)]


def test_random_words_equal_all_windows(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c.", "d", "e!"]
    pieces = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(80):
        own = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 9))] for _ in range(3)]
        parts = [own[0], rng.choice(pieces), own[1], rng.choice(pieces)[rng.randint(0, 9) :], own[2]]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w for part in parts for w in part)))
    rows.append((None, rows[7][1] + " " + "x " * 90))
    for n in (1, 4, 9, 16, 50):
        docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA)
        found = {r.doc.doc_id: r.text.split() for r in dedup_lines(docs, LineParams(n)).collect()}
        want = words_left(rows, n)
        assert found == {i: want[k] for k, (i, _) in enumerate(rows)}, n


def test_anchors_are_told_by_the_window_alone():
    import numpy as np

    from shelfcast.llm.line_dedup import anchor_width, selected

    assert [anchor_width(n) for n in (1, 2, 7, 16, 50)] == [1, 2, 4, 8, 32]
    names = np.array([5, 3, 3, 9, 1, 1, 7])
    assert selected(names, 4).tolist() == [1 if i == 0 else 4 for i in range(4)]
    assert selected(names, 1).tolist() == list(range(7))
    assert selected(names[:3], 4).tolist() == []


def test_lines_end_behind_a_sentence_before_any_white_space():
    import numpy as np

    text = "A b.\tC d!\r\nE f?\u00a0G 3.5\tkg. \t H\u2003i.\u3000J"
    assert lines_of(text) == ["A b.", "C d!", "E f?", "G 3.5\tkg.", "H\u2003i.", "J"]
    assert cut_text(text, np.array([2]), np.array([4])) == ("A b.\t" + text[text.index("G") :], 6, 2)
    passage = cut_text("One.\tTwo three.\rFour.", np.array([1]), np.array([2]))
    assert passage == ("One.\tFour.", 3, 1)
