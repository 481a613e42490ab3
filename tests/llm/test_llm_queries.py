"""Registered queries of the subpackage against their SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from climastar.llm.oracle import ORACLE
from climastar.llm.queries import QUERIES
from conftest import SF0001
from oracle_compare import compare, duck

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, SF0001, name, QUERIES[name], ORACLE[name], duck(SF0001))
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_every_row(spark, name):
    rows = QUERIES[name](spark, SF0001)
    table = "pages" if "page_id" in rows.columns else "documents"
    assert rows.count() == spark.read.parquet(f"{SF0001}/{table}.parquet").count()


def test_stages_in_order(spark, tmp_path):
    """Every stage runs on what the one before it kept, hands on the columns, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    item = spark.read.parquet(f"{SF0001}/benchmark.parquet").first().text
    filler = docs.where("n_chars > 700").first().text
    more = spark.createDataFrame([(90001, None, "en", "s", 0), (90002, "123 !!", None, "s", 6), (90003, "", "en", None, 0),
                                  (90004, "unheard of " + item + " and so on", "en", "s", None), (None, "a row without any id", "en", "s", 5),
                                  (90005, "zq " + filler[:600], "en", "s", 1)], SCHEMA)
    now = docs.union(more.union(more.where("doc_id = 90004")))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SF0001).write.parquet(f"{tmp_path}/{name}")
        new = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "bpe":
            assert new.columns == docs.columns
        kept[name], now = new, new
    ids = {k: [r.doc_id for r in v.select("doc_id").collect()] for k, v in kept.items()}
    assert not {90001, 90002, 90003} & set(ids["language_id"]) and None in ids["language_id"]
    assert len(ids["language_id"]) == docs.count() + 4
    assert len(ids["simhash_near_dedup"]) == len(set(ids["simhash_near_dedup"])) and ids["simhash_near_dedup"].count(90004) == 1
    assert sorted(map(str, ids["suffix_array_dedup"])) == sorted(map(str, ids["simhash_near_dedup"]))
    short = kept["suffix_array_dedup"].where("doc_id = 90005").first()
    assert len(short.text) < 100 and short.n_chars == len(short.text)
    assert 90004 not in ids["benchmark_decontamination"] or item not in kept["suffix_array_dedup"].where("doc_id = 90004").first().text
    last = kept["bpe"].join(kept["benchmark_decontamination"].select("doc_id", F.col("text").alias("was")), "doc_id")
    assert last.where("text <> was or n_tokens <> size(ids)").count() == 0


def test_stages_against_brute_force(spark, tmp_path):
    """Ids and texts that each stage keeps, computed plainly."""
    from collections import Counter

    from test_llm_text import brute_components, brute_simhash
    from tokenizers import Tokenizer

    from climastar.llm.queries import tokenizer_path

    docs = spark.read.parquet(f"{SF0001}/documents.parquet").orderBy("doc_id").limit(50)
    long = docs.where("n_chars > 900").first()
    item = spark.read.parquet(f"{SF0001}/benchmark.parquet").orderBy("item_id").first().text
    more = spark.createDataFrame([(90001, "?! 1", "en", "s", 4), (90002, long.text, "en", "s", 1), (90003, "Zo " + long.text[100:700] + " yes", "en", "s", 1),
                                  (90004, "a quite new text with " + item, "en", "s", 1)], SCHEMA)
    now = docs.union(more)
    rows = {r.doc_id: r.text for r in now.collect()}
    assert len(rows) == 54

    def run(name, df):
        dict(corpus_pipeline.STAGES)[name](spark, df, SF0001).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        return out, {r.doc_id: r.text for r in out.collect()}

    now, got = run("language_id", now)
    rows = {d: t for d, t in rows.items() if any(c.isalpha() for c in t)}
    assert got == rows and 90001 not in rows

    now, got = run("simhash_near_dedup", now)
    prints = [(d, brute_simhash(t, 3)) for d, t in rows.items()]
    rows = {d: rows[d] for (d, _), c in zip(prints, brute_components(prints)) if d == c}
    assert got == rows and 90002 not in rows

    now, got = run("suffix_array_dedup", now)
    data = {d: t.encode() for d, t in rows.items()}
    seen = Counter(b[i:i + 200] for b in data.values() for i in range(len(b) - 199))
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"x" * 200
        rows[d] = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    assert got == rows and len(rows[90003]) < 20

    now, got = run("benchmark_decontamination", now)
    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    items = [s for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect() if (s := shingles(r.text))]
    rows = {d: t for d, t in rows.items() if not any(5 * len(s & shingles(t)) >= 4 * len(s) for s in items)}
    assert got == rows

    now, got = run("bpe", now)
    lib = Tokenizer.from_file(tokenizer_path())
    assert got == rows
    assert {r.doc_id: list(r.ids) for r in now.collect()} == {d: lib.encode(t, add_special_tokens=False).ids for d, t in rows.items()}


def test_run_applies_the_stages(spark):
    got = corpus_pipeline.run(spark, SF0001)
    assert 0 < got.count() < spark.read.parquet(f"{SF0001}/documents.parquet").count()


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
        assert docs.count() == 0


def test_every_group_keeps_a_document_though_ids_repeat(spark):
    """Two unrelated texts under one id, each with a copy under another id."""
    from climastar.llm import simhash_dedup

    a, b = " ".join(f"alpha{i}" for i in range(40)), " ".join(f"beta{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a), (3, b), (None, "x y z"), (None, None), (None, ""), (4, "x y z")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text or "") for r in simhash_dedup.keep_one(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, a), (1, b), (4, "x y z"), (None, "")]))


def test_language_id_stage_rejects_only_what_it_can_tell(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert stage(spark, unlabelled, SF0001).count() == docs.count()                 # nothing to learn from
    assert stage(spark, docs, SF0001).count() == docs.count()                        # all have a letter and a language
    # Two languages with as many documents each: what could be either is not told.
    rng = __import__("random").Random(1)
    words = {"de": "der und nicht haus gehen über schön".split(), "fr": "le et pas maison aller été où".split()}
    two = [(i, " ".join(rng.choice(words[x]) for _ in range(15)), x, "s", 1) for i, x in enumerate(["de", "fr"] * 60)]
    odd = [(90001, "Γειά σου κόσμε, τι κάνεις σήμερα φίλε μου", None, "s", 1), (90002, "12 !?", "de", "s", 1), (90003, "der und nicht haus le et pas maison", None, "s", 1)]
    kept = {r.doc_id for r in stage(spark, spark.createDataFrame(two + odd, SCHEMA), SF0001).collect()}
    assert set(range(120)) <= kept and not kept & {90001, 90002}
    one = stage(spark, docs.where("lang = 'de'"), SF0001)                            # a single language is never a guess
    assert one.count() == docs.where("lang = 'de'").count()


def test_stages_hand_on_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").orderBy("doc_id").limit(40)
    names = ["score", "held_out", "lang_pred", "__p", "predicted", "__id", "__hash", "__key", "__kept", "__text", "row", "id", "hash", "class", "h", "o",
             "bad_id", "a`b", "with space"]
    more = docs
    for c in names:
        more = more.withColumn(c, F.concat(F.lit(c), F.lit("!")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, more, SF0001)
        assert got.columns == more.columns and got.dtypes == more.dtypes, name
        rows = got.collect()
        assert rows and all(r[c] == c + "!" for r in rows for c in names), name


def test_samples_are_bounded_before_they_are_collected(spark):
    """An id with very many equal rows counts once; a language keeps at most its number of rows."""
    from climastar.llm import langid

    rng = __import__("random").Random(1)
    rows = [(1, "the same text again", "en")] * 300
    rows += [(i, " ".join(rng.choice(("der", "und", "nicht", "haus")) for _ in range(12)), "de") for i in range(10, 120)]
    rows += [(i, " ".join(rng.choice(("the", "and", "house", "not")) for _ in range(12)), "en") for i in range(200, 240)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = langid.train(df, per_language=30)
    assert model.labels == ["de", "en"]
    assert model.probabilities(langid.ngram_counts("das haus und der hund nicht"))[0] > 0.6
