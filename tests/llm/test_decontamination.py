import random

import pytest

from storelens.llm import decontamination as dc

from .conftest import SF_DIR, clash, rows_of


def plain_distance(item, words):
    """Least edit distance of the item from any stretch of words: places where the best ones end."""
    row = [0] * (len(words) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (word != other)))
        row = new
    return row[1:]


def plain(documents, items):
    out = set()
    for doc_id, text in documents:
        words = dc.words_of(text)
        for item_id, item in items:
            parts = dc.words_of(item)
            if item_id is None or not parts or not words:
                continue
            ends = plain_distance(parts, words)
            if min(ends) <= dc.error_budget(len(parts)):
                out.add((doc_id, item_id, ends.index(min(ends)), min(ends), len(parts)))
    return out


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"x{rng.randrange(1000)}"
        elif kind == 1:
            words.insert(at, f"y{rng.randrange(1000)}")
        elif len(words) > 1:
            del words[at]
    return words


def found(df, items):
    return {(r["doc_id"], r["item_id"], r["last_word"], r["distance"], r["n_words"])
            for r in dc.contaminated(df, items).collect()}


def test_agrees_with_full_edit_distance(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 8, 15, 30, 70, 130]))))
             for i in range(40)]
    items += [(50, None), (51, ""), (52, "!!"), (None, "w1 w2 w3 w4"), (3, items[3][1]), (60, items[5][1])]
    rows = [(1, None), (2, ""), (None, items[20][1])]
    for doc_id in range(10, 60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        item = items[rng.randrange(40)][1].split()
        words[len(words) // 2:len(words) // 2] = edited(rng, item, rng.randrange(0, 2 + len(item) // 4))
        rows.append((doc_id, ", ".join(words).upper()))
    rows += [rows[-1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = plain(rows, items)
    assert found(clash(df), clash(benchmark)) == want
    hit = {r[0] for r in want}
    assert rows_of(dc.decontaminated(df, benchmark), "doc_id") == sorted(
        [(d,) for d, _ in rows if d not in hit], key=lambda r: (r[0] is not None, r[0] or 0))


def test_agrees_on_the_tables(spark, documents):
    some = documents.filter("doc_id < 150")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in some.collect()], [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    assert found(some, benchmark) == want and want


def test_passes_change_nothing(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want, kept = found(documents, benchmark), rows_of(dc.decontaminated(documents, benchmark), "doc_id")
    monkeypatch.setattr(dc, "PASS_ITEMS", 15)
    assert found(documents, benchmark) == want
    assert rows_of(dc.decontaminated(documents, benchmark), "doc_id") == kept


@pytest.mark.parametrize("table", ["edge", "empty"])
def test_edges(request, spark, table):
    df = request.getfixturevalue(table)
    items = spark.createDataFrame([(1, "cat sat on the mat and looked"), (2, "one")], "item_id long, text string")
    want = plain([(r["doc_id"], r["text"]) for r in df.collect()], [tuple(r) for r in items.collect()])
    assert found(df, items) == want
    none = items.filter("item_id > 5")
    assert found(df, none) == set() and dc.decontaminated(df, none).count() == df.count()
    assert dc.decontaminated(clash(df), items).columns == clash(df).columns


def test_first_word_begins_the_match():
    matcher = dc.Matcher([(1, "a b c d e f g h i j")])
    assert matcher.matches("x a b c d e f g h i j y") == [(1, 1, 10, 0)]
    assert matcher.matches("x a b z c d e f g h i j y") == [(1, 1, 11, 1)]
    assert matcher.matches("x b c d e f g h i j y") == [(1, 1, 9, 1)]
    assert matcher.matches("x a b c d y") == []


def test_words_are_those_of_the_text_that_matches(spark):
    """An id with two texts of different length."""
    items = spark.createDataFrame([(1, "red green blue"), (1, "one two three four five six seven")], "item_id long, text string")
    docs = spark.createDataFrame([(5, "so red green blue it is"), (6, "one two three four five six seven")], "doc_id long, text string")
    rows = dc.contaminated(docs, items).select("doc_id", "n_words").collect()
    assert sorted(map(tuple, rows)) == [(5, 3), (6, 7)]
