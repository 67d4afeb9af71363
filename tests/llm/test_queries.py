"""The operators on awkward and empty tables, and the queries against SQL and plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import normal
from tablegrade.llm import decontamination, html_text, language, licenses, lsh_forest, packing, quality, sharding, toxicity, urls
from tablegrade.llm.queries import ORACLE, QUERIES

LINE = "the quick brown fox jumps over the lazy dog and runs into the green wood again "
AWKWARD = [
    (1, LINE * 4, "en"), (1, LINE * 4, "en"), (2, LINE * 4, None), (None, LINE * 4, "en"), (3, None, "en"), (4, "", "de"), (5, " \n\t", None),
    (6, "word " * 30_000, "en"), (7, "12 !! ##", "en"), (None, None, None), (8, "All rights reserved. CC BY 4.0", "en"), (9, "one two", "de"),
]


#: Names that the operators use inside.
CLASHING = ["_id", "_text", "place", "item", "w", "said", "group", "stays", "times", "_n", "_bucket", "row"]


@pytest.fixture(scope="module")
def awkward(spark):
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string")
    return docs.select("*", F.lit("x").alias("source"), F.lit(1).alias("n_chars"), F.lit(9).alias("key_id"), F.lit(0).alias("class"), F.lit(0).alias("a.b"), *[F.lit(0).alias(c) for c in CLASHING])


def test_awkward_rows(spark, awkward):
    n = len(AWKWARD)
    profiles = language.learn(awkward)
    said = {(r["doc_id"], r["lang_pred"]) for r in language.identify(awkward, profiles).collect()}
    assert (3, "und") in said and (7, "und") in said and (1, "en") in said
    assert language.keep_known(awkward, profiles, least=0.2).columns == awkward.columns
    assert quality.judge(awkward).count() == n
    found = {r["doc_id"]: r for r in licenses.licenses(awkward).collect()}
    assert (found[8]["n_base"], found[8]["base_labels"], found[8]["first_word"], found[8]["last_word"]) == (2, "cc-by,reserved", 0, 3)
    assert (found[3]["n_words"], found[3]["labels"]) == (0, "")
    placed = sharding.shard(awkward, 3).collect()
    assert len(placed) == n and len({(r["shard"], r["slot"]) for r in placed}) == n
    pieces = packing.pack(awkward).collect()
    assert sum(r["length"] for r in pieces if r["start"] == 0 and r["doc_tokens"] == 1) == 3
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.score(awkward, toxicity.learn(toxicity.labelled_texts(awkward, labels))).collect()
    assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)


def test_awkward_rows_near_duplicates(awkward):
    rows = lsh_forest.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["class_id"] for r in rows if r["key_id"] in (1, 2)} == {1}
    kept = lsh_forest.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 7, 8, 9]


def test_awkward_rows_decontamination(spark, awkward):
    items = spark.createDataFrame([(1, LINE), (2, None), (3, ""), (4, "one two"), (5, LINE)], "item_id long, text string")
    found = {(r["key_id"], r["item_id"]) for r in decontamination.contaminated(awkward, items).collect()}
    assert found == {(1, 1), (1, 5), (2, 1), (2, 5), (None, 1), (None, 5), (9, 4)}
    clean = decontamination.clean(awkward, items)
    assert clean.columns == awkward.columns and clean.count() == len(AWKWARD) - 5


def passages_found(docs: dict, items: dict) -> dict:
    """Per document and item the highest weighted Jaccard index of any item-sized window, by trying all of them; 0.8 or more."""
    grams = lambda words: Counter(tuple(words[i : i + min(5, len(words))]) for i in range(max(len(words) - 4, 1)))
    words_of = lambda text: re.findall(r"\w+", (text or "").lower())
    bags = {i: (len(words_of(t)), grams(words_of(t))) for i, t in items.items() if words_of(t)}
    unique = {(n, frozenset(bag.items())) for n, bag in bags.values()}
    holding = Counter(gram for _, bag in unique for gram, _ in bag)
    weight = lambda gram: math.log1p(len(unique) / holding[gram]) if gram in holding else math.log1p(len(unique))
    best: dict = {}
    for doc, text in docs.items():
        words = words_of(text)
        every = {k: {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} for k in range(1, 6)}
        for item, (n, bag) in bags.items():
            if not every[min(n, 5)] & bag.keys():
                continue
            for start in range(len(words) - n + 1):
                window = grams(words[start : start + n])
                if window.keys() & bag.keys():
                    both = sum(weight(g) * k for g, k in (window & bag).items())
                    index = both / sum(weight(g) * k for g, k in (window | bag).items())
                    if index >= 0.8 - 1e-9:
                        best[doc, item] = max(best.get((doc, item), 0), index)
    return best


def test_decontamination_by_brute_force(spark, tiny):
    """All documents of the smallest tables, and copies of items with one or two words edited at any place, between other words."""
    rows = pq.read_table(f"{tiny}/documents.parquet").to_pandas()
    docs = dict(zip(rows["doc_id"].tolist(), rows["text"], strict=True))
    held = pq.read_table(f"{tiny}/benchmark.parquet").to_pandas()
    items = dict(zip(held["item_id"].tolist(), held["text"], strict=True))
    rng = random.Random(5)
    for i, text in enumerate(list(items.values()) * 3):
        words = text.split()
        for _ in range(1 + i % 2):
            words[rng.randrange(len(words)) if i % 3 else 0] = f"edited{rng.randrange(10**6)}"
        docs[10**6 + i] = " ".join(["before"] * (i % 7) + words + ["after"] * (i % 5))
    asked = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = decontamination.contaminated(asked, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    expected = passages_found(docs, items)
    assert {(r["key_id"], r["item_id"]) for r in found} == set(expected) and len(found) > 40
    assert all(abs(r["similarity"] - expected[r["key_id"], r["item_id"]]) < 1e-6 for r in found)


def test_empty_tables(spark, awkward):
    empty, items = awkward.limit(0), spark.createDataFrame([], "item_id long, text string")
    profiles = language.learn(empty)
    assert language.identify(empty, profiles).count() == 0
    assert {r["lang_pred"] for r in language.identify(awkward, profiles).collect()} == {"und"}
    assert quality.judge(empty).count() == licenses.licenses(empty).count() == sharding.shard(empty).count() == packing.pack(empty).count() == 0
    assert lsh_forest.near_duplicates(empty).count() == decontamination.contaminated(awkward, items).count() == 0
    model = toxicity.learn(toxicity.labelled_texts(empty, spark.createDataFrame([], "doc_id long, toxic int")))
    assert {r["predicted"] for r in toxicity.score(awkward, model).collect()} == {0}


def test_urls(spark):
    pages = [(1, "http://a.org/x/?utm_q=1#t"), (2, "https://www.a.org:443/x"), (3, None), (4, "no scheme"), (5, "HTTP://WWW.Example.com/en/1"), (6, "x://net/es/")]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    listed = spark.createDataFrame([("https://a.org/x",), (None,)], "u string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, listed).collect()}
    assert found[1] == ("a.org", "/x/", None, "block") and found[2][3] == "block"
    assert found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and found[6][2:] == ("net/es/", "block")
    assert urls.judge(pages.limit(0), listed).count() == urls.judge(pages, listed.limit(0)).count() - 6 == 0


def test_filter_passes_all_listed_keys(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    tested = urls.passes(spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), "id"), "k", keys, "k")
    assert tested.filter("id < 5000 AND NOT _possible").count() == 0
    assert tested.filter("id >= 5000 AND _possible").count() < 150


def test_permutation_and_its_inverse(spark):
    for rows in (1, 2, 3, 10, 1000):
        frame = spark.range(rows).select("id", sharding.permuted(F.col("id"), rows, 5).alias("p"))
        frame = frame.select("id", "p", sharding.row_at(F.col("p") % 8, F.floor(F.col("p") / 8), rows, 8, 5).alias("back"))
        found = frame.collect()
        assert sorted(r["p"] for r in found) == list(range(rows)) and all(r["back"] == r["id"] for r in found)


def test_shuffle_depends_on_rows_alone(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert set(sharding.shard(docs).collect()) == set(sharding.shard(docs.repartition(7).orderBy(F.rand())).collect())


def test_places_are_the_same_under_all_settings(spark, tiny):
    """Shard and slot don't depend on shuffle partitions or files, and are those of the permutation worked out in Python."""
    docs, found = spark.read.parquet(f"{tiny}/documents.parquet"), []
    for partitions in ("1", "4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append({tuple(r) for r in sharding.shard(docs.repartition(int(partitions) + 2)).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] == found[2]
    rows = sorted(found[0], key=lambda r: r[3])
    assert [r[3] for r in rows] == list(range(len(rows)))
    assert sorted((r[4], r[5]) for r in rows) == sorted((i % 8, i // 8) for i in range(len(rows)))


def test_packing_of_long_stretches(spark):
    texts = ["x" + " " * 1_000_000 + "y", "!" * 30_000, "\n" * 50_000 + "z", "word " * 20_000]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.default_tokenizer())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(docs).collect()}
    assert found == {i: len(plain.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_languages_are_learned_from_all_documents(spark, monkeypatch):
    rng = random.Random(4)
    texts = [("xy"[i % 2], "".join(rng.choice("abcdefgh") for _ in range(5))) for i in range(14_000)]
    docs = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(texts)], "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "HELD_GRAMS", 50)
    profiles = language.learn(docs)
    for place, lang in enumerate(profiles.languages):
        counts = Counter()
        for own, text in texts:
            if own == lang:
                values, numbers = language.grams(text)
                counts.update(dict(zip(values.tolist(), numbers.tolist())))
        best = sorted(counts, key=lambda gram: (-counts[gram], gram))[: language.RANKS]
        ranks = {int(gram): int(rank) for gram, rank in zip(profiles.known, profiles.places[place]) if rank < language.RANKS}
        assert ranks == {gram: rank for rank, gram in enumerate(best)}
    monkeypatch.setattr(language, "sampled", None)
    assert language.language_stage(spark, docs, "").columns == docs.columns


def test_texts_that_resemble_no_language(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    profiles = language.learn(docs)
    least = language.least_score(language.sampled(docs), profiles)
    assert language.least_score(docs.limit(0), profiles) == 0 and 0.2 < least < 0.6
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(200))
    other = "Tämä on suomenkielinen teksti, jossa kerrotaan metsästä ja järvestä sekä siitä, miten kesäyö on valoisa. " * 5
    foreign = spark.createDataFrame([(1, noise), (2, other), (3, "² ½ ①"), (4, "١٢٣ 12")], "doc_id long, text string")
    assert language.keep_known(foreign, profiles, least=least).count() == 0
    assert {r["lang_pred"] for r in language.identify(foreign.filter("doc_id > 2"), profiles).collect()} == {"und"}
    assert language.keep_known(docs, profiles, least=least).count() >= 0.99 * docs.filter("text is not null").count()


def test_pages_lose_no_text(spark, tiny):
    """The whole text of every article, with what stands around it, without it and with nothing after it; no comments."""
    tree = html_text.train(spark)
    for page in (r["html"] for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.DOTALL)
        wanted = "\n".join(b.text for b in html_text.blocks_of(article[1]))
        for cut in (page, page[: article.end()], article[0], page[article.end() :] + article[0]):
            assert html_text.main_text(cut, tree) == wanted
    words = " ".join(["word"] * 60)
    comment = f"<div class='comments'><article class='comment'><p>{words}</p></article></div><article class='comment-body'><p>{words}</p></article>"
    for page, wanted in (
        (f"<article><p>{words}</p></article>", words),
        (f"<article><h1>Title</h1><p>{words}</p></article>", f"Title\n{words}"),
        (f"<article><p>{words}</p></article>{comment}", words),
        (f"<article><p>{words}</p><svg><p>{words}</p></article>", f"{words}\n{words}"),
        (f"<article><div class='post-header'><h1>A headline</h1></div><p>{words}</p></article>", f"A headline\n{words}"),
        (f"<article><p>{words}</p><script>{words}", words),
    ):
        assert html_text.main_text(page, tree) == wanted
    rows = [(1, f"<article><p>{words}</p></article>"), (1, f"<article><p>{words}</p></article>"), (2, None), (3, ""), (None, "<br>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").select("*", F.lit(1).alias("main"), F.lit("old").alias("text"))
    found = html_text.extract(pages, tree)
    assert found.columns == pages.columns and sorted(r["text"] for r in found.collect()) == ["", "", "", words, words]
    assert html_text.extract(pages.limit(0), tree).count() == 0


def test_template_beside_stray_runs(spark):
    listed = " ".join(f"name{i} MIT License" for i in range(40))
    notice = "Released under the MIT License"
    texts = [listed, f"{listed} {notice} {listed}", f"{notice} {listed}", "Released under the new MIT License", f"{notice}. {LINE} {notice}."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.licenses(docs).collect()}
    assert found == {0: ("", 0.0), 1: ("mit", 1.0), 2: ("mit", 1.0), 3: ("", 0.0), 4: ("mit", 1.0)}
    spans = [(r["first_word"], r["last_word"]) for r in licenses.scan(docs.filter("doc_id = 1")).filter("NOT base").collect()]
    assert spans == [(120, 123)]


def test_sql(spark, tiny):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tiny}/pages.parquet'")
    for name, sql in ORACLE.items():
        assert normal(QUERIES[name](spark, tiny).toPandas()) == normal(duck.execute(sql).fetchdf())


def test_native_plans(spark, tiny):
    for name in ("op1_url_filters", "op9_sharding"):
        plan = QUERIES[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_held_out_languages_and_main_text(spark, tiny):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    found = [r for r in QUERIES["op6_language_id"](spark, tiny).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in found)
    assert sum(docs[r["doc_id"]] == r["lang_pred"] for r in found) > 0.97 * len(found)
    pages = html_text.extract(spark.read.parquet(f"{tiny}/pages.parquet"), html_text.train(spark)).collect()
    for page in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.DOTALL)[1]
        assert len(page["text"].split()) == len(re.sub(r"<[^>]*(?:>|\Z)", " ", inner).split())


def test_near_duplicates_by_brute_force(spark, tiny):
    rows = pq.read_table(f"{tiny}/documents.parquet").to_pandas()
    sets = {i: frozenset(lsh_forest.shingles(t).tolist()) for i, t in zip(rows["doc_id"], rows["text"], strict=True)}
    classes = set(sets.values())
    links = {a: sum(a != b and len(a & b) / len(a | b) >= 0.8 for b in classes) for a in classes}
    found = QUERIES["op3_ngram_jaccard_join"](spark, tiny).collect()
    assert all(r["n_links"] == links[sets[r["doc_id"]]] for r in found)
    assert all(r["class_id"] == min(i for i, s in sets.items() if s == sets[r["doc_id"]]) for r in found)


def test_weak_links_beside_a_hot_group(spark):
    """300 pairs of similarity 0.8 exactly, and one group of 80 very similar texts that has most links."""
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    edited = lambda base, at: " ".join([*base[:at], *words(1), *base[at + 1 :]])
    rows = []
    for i in range(300):
        base = words(49)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, edited(base, 24))]
    hot = words(400)
    rows += [(1000 + i, edited(hot, 5 * i)) for i in range(80)]
    found = {r["key_id"]: r["n_links"] for r in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[1000 + i] == 79 for i in range(80))
    assert sum(found[2 * i] == 0 for i in range(300)) <= 3


def test_pipeline(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored_once(stage(spark, docs, tiny))
        now = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == columns and now <= kept, name
        kept = now
    assert {r["doc_id"] for r in corpus_pipeline.packing_stage(spark, docs, tiny).collect()} == kept
