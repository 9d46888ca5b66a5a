"""Inputs that once lost rows or failed: deep pages, odd attributes, many languages, shared ids, other spellings of a question."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barline.llm import contamination, language, neardup, pages, sentencepiece


@pytest.fixture(scope="module")
def model():
    import pyarrow.parquet as pq

    counts = Counter()
    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist():
        counts.update(pages.counted(page))
    return pages.learned(counts)


PAGES = {
    '<article><h1>Short title</h1><div class="ad">buy this fine new car today for less money than ever before and more</div><p>First para with several words.</p><p>Second para.</p></article>': "Short title\nFirst para with several words.\nSecond para.",
    "<article><h1>Short title</h1><aside><ul><li>one link</li><li>two links here</li></ul></aside><p>First para with several words.</p></article>": "Short title\nFirst para with several words.",
    "<main><p>Some words of a start para that is long.</p><nav><a>l1</a><a>l2</a><a>l3</a><a>l4</a></nav><p>End para of it.</p></main>": "Some words of a start para that is long.\nEnd para of it.",
    "<article><p>a b c d</p><table><tr><td>1</td></tr></table><p>more words are in this para</p></article>": "a b c d\n1\nmore words are in this para",
    "<article><p title=it's>one two three <a href=x title=don't>four</a> five</p><p>Other words and more.</p></article>": "one two three four five\nOther words and more.",
    '<div class="content search-results"><p>one two three four five.</p><p>more words here.</p></div>': "one two three four five.\nmore words here.",
    '<article class="article-subscribe-body"><p>one two three four five.</p></article>': "one two three four five.",
}


def test_no_part_of_an_article_is_lost(model):
    for page, text in PAGES.items():
        assert pages.main_text(f"<html><body><nav><ul><li>Home</li></ul></nav>{page}<footer>us</footer></body></html>", model) == text


def test_held_out_articles_without_their_mark(model):
    import re

    import pyarrow.parquet as pq

    found = wanted = given = 0
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        inside = Counter(pages.main_text(re.search("<article.*?</article>", page, re.S)[0], model).split("\n"))
        bare = re.sub(r"<(/?)(article|main)\b[^>]*>", r"<\1div>", page)
        got = Counter(pages.main_text(bare, model).split("\n"))
        found, wanted, given = found + (got & inside).total(), wanted + inside.total(), given + got.total()
    assert found >= 0.99 * wanted and found >= 0.99 * given


@pytest.mark.parametrize("part", ["<div>", '<a "', "<a x='", "<p><b><i>w ", "<ul><li>word", "</b></i>", "<div><span></b>"])
def test_deep_and_unclosed_pages_take_linear_time(model, part):
    def seconds(n):
        start = time.process_time()
        pages.main_text(part * n, model)
        pages.counted("<main>" + part * n)
        return time.process_time() - start

    seconds(100)
    assert seconds(40_000) < 12 * max(seconds(5_000), 0.02)


def test_more_than_64_languages(spark):
    rng = random.Random(4)
    letters = [chr(0x100 + k) for k in range(400)]
    rows = []
    for k in range(100):
        own = ["".join(rng.sample(letters[3 * k : 3 * k + 40], 5)) for _ in range(30)]
        rows += [(f"l{k:03}", " ".join(rng.choices(own, k=25)), "kept") for _ in range(8)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id long, lang string, text string, score string")
    fitted = language.fit(df.where("doc_id % 8 < 6"))
    assert len(fitted.languages) == 100 and len(fitted.tables) == 2
    got = language.predict(df.where("doc_id % 8 >= 6"), fitted)
    assert got.columns == [*df.columns, "lang_pred"]
    assert np.mean([r.lang_pred == r.lang for r in got.collect()]) > 0.97


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    a, b, c, d = (" ".join(random.Random(k).choices("abcdefghijklmnop", k=60)) for k in range(4))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (None, d), (None, d), (None, a), (None, None), (8, None), (8, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _shared string, count long").repartition(3)
    got = neardup.deduplicated(df)
    assert got.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(1, a), (5, b), (7, c), (None, d), (None, None), (8, None), (8, "")], key=str)


def test_links_found_in_later_bands_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "FIRST_PROPOSALS", 1)
    rng = random.Random(12)
    docs = []
    for group in range(4):
        words = [f"{group}w{rng.randrange(400)}" for _ in range(80)]
        for _ in range(14):
            copy = list(words)
            for at in rng.sample(range(80), rng.randint(0, 2)):
                copy[at] = f"x{rng.randrange(9999)}"
            docs.append((len(docs), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df, least=0.85).collect()}
    assert got == neardup.brute(dict(docs))


QUESTION = "Anna paid 12 dollars for 5 red pens and then sold twelve of them to José in Rome for 1/2 of the old price"


@pytest.mark.parametrize(
    "changes",
    [
        {"12": "8", "5": "8"},
        {"twelve": "thirty"},
        {"twelve": "17"},
        {"José": "Éva", "Rome": "Ávila"},
        {"Anna": "MARIA", "José": "PEDRO"},
        {"1/2": "3/4", "5": "$9"},
        {"12 dollars": "20 euros"},
    ],
)
def test_other_spellings_of_a_question(spark, changes):
    text = QUESTION
    for old, new in changes.items():
        text = text.replace(old, new)
    docs = spark.createDataFrame([(1, f"so it goes. {text}. and on it went"), (2, "one of them paid for red pens in the old town")], "doc_id long, text string")
    found = contamination.contaminated(docs, spark.createDataFrame([(3, QUESTION)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 3)] and found[0].changed_slots >= 1


def test_coded_columns_replace_those_of_the_same_name(spark):
    docs = spark.createDataFrame([(1, "some text", "old", 7)], "doc_id long, text string, ids string, exact int")
    out = sentencepiece.encode(docs, sentencepiece.vocabulary())
    assert out.columns == [*docs.columns, "decoded_sha256"] and out.first().exact is True
    assert pa.types.is_list(pa.array([out.first().ids]).type)
