"""Empty tables, clashing columns, SQL forms, the pipeline and registration."""

import os

import duckdb
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import (decontaminate, llr_quality, mixing, ngram_join, pii, quality_classifier, queries, secret_scan,
                            substring_dedup, token_counts, url_trust)

SF = "/root/testdata/sf0.001"


def _vocabulary():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _operators(spark, labels):
    benchmark = spark.createDataFrame([(1, "nosuch words")], "item_id long, text string")
    return {
        "mix": lambda d: mixing.mix(d), "amounts": lambda d: mixing.mixed_amounts(d),
        "llr": lambda d: llr_quality.score_quality(d, labels), "substring": substring_dedup.remove_repeats,
        "ngram": ngram_join.near_duplicates, "ngram drop": ngram_join.drop_near_duplicates,
        "benchmark": lambda d: decontaminate.decontaminate(d, benchmark),
        "benchmark drop": lambda d: decontaminate.drop_contaminated(d, benchmark),
        "tokens": lambda d: token_counts.token_prefixes(d, _vocabulary()), "secrets": secret_scan.find_secrets,
        "classifier": lambda d: quality_classifier.classify(d, labels), "pii": pii.find_personal_data,
        "pii mask": lambda d: pii.mask(pii.find_personal_data(d)),
    }


def test_empty_tables(spark, nothing, no_labels):
    for name, op in _operators(spark, no_labels).items():
        assert op(nothing).count() == 0, name
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_trust.judge_pages(pages).count() == 0


def test_other_columns_and_all_rows_stay(spark, awkward, no_labels):
    """No labels, no benchmark match: every row stays, with columns that carry internal names."""
    for name, op in _operators(spark, no_labels).items():
        if name in ("mix", "amounts", "ngram", "benchmark", "ngram drop"):
            continue
        got = op(awkward)
        assert got.count() == awkward.count(), name
        assert {"lang", "n_chars", "n", "w", "id"} <= set(got.columns), name
    mixed = mixing.mix(awkward)
    assert {"size", "tag", "key", "n", "id"} <= set(mixed.columns) and mixed.count() > 0
    assert mixed.filter("n IS NOT NULL AND (n <> 'n' OR size <> 'z')").count() == 0


def test_empty_benchmark_and_null_items(spark, awkward):
    for rows in ([], [(1, None), (2, " "), (3, "")]):
        got = decontaminate.decontaminate(awkward, spark.createDataFrame(rows, "item_id long, text string"))
        assert got.filter("contaminated").count() == 0 and got.count() == awkward.count()


def test_classifier_without_or_with_one_class(spark, awkward, no_labels):
    got = quality_classifier.classify(awkward, no_labels)
    assert [tuple(r) for r in got.select("score", "predicted").distinct().collect()] == [(0.5, 1)]
    ones = spark.createDataFrame([(i, 1) for i in range(1, 17)] + [(None, 0), (3, 7)], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.classify(awkward, ones).select("score").collect()} == {1.0}


def test_url_nulls_and_repeated_pages(spark):
    rows = [(1, "http://a.com/de/", None), (1, "http://a.com/de/", None), (None, None, "<a href=http://q.net>"), (2, "://", "")]
    got = url_trust.judge_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got.count() == 4 and got.filter("verdict IS NULL").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_forms(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    a = queries.QUERIES[name](spark, SF)
    b = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in b.description]
    assert sorted(cols) == sorted(a.columns)
    assert sorted(map(str, map(tuple, a.select(*cols).collect()))) == sorted(map(str, b.fetchall()))


def test_trust_over_links_equals_the_sql_form(spark, tmp_path):
    """Pages that link hosts, one of them blocked: the rounds, their rounding and the verdicts of both engines."""
    to = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    rows = [(k, f"http://h{k}.net/", to(*[f"h{(k * 7 + j) % 40}.net" for j in range(k % 5)])) for k in range(40)]
    rows += [(100, "http://good.org/", to("h1.net", "h2.net")), (101, "http://bad.com/de/", to("h3.net")), (102, "http://fan.net/", to("bad.com", "h5.net")),
             (103, "http://h6.net/", to("bad.com")), (104, "http://sub.example.org/es/", to("h7.net")), (105, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(map(str, con.execute(queries.ORACLE["op5_url_trust"]).fetchall()))
    got = queries.op5_url_trust(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, map(tuple, got))) == want
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_queries_return_all_documents(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, q in queries.QUERIES.items():
        if name not in ("op5_url_trust", "op11_conversation_repair", "op13_collocations"):
            assert q(spark, SF).count() == n, name


def test_digests(spark):
    docs = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.op10_pii(spark, SF).collect():
        spans = plain.personal(docs[r.doc_id])
        assert r.base_sha256 == plain.sha(plain.listed(spans)) and r.n_email == sum(s[0] == "email" for s in spans)
        assert set(filter(None, plain.listed(spans).split(","))) <= set(r.spans.split(","))
    for r in queries.op2_llr_quality(spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == \
            plain.base_quality(docs[r.doc_id])


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_stages(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _, _ in stages] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII",
                                         "mixing sources to target weights"]
    for _, _, after in stages[:-1]:
        assert after.columns == docs.columns
    ids = [{r[0] for r in a.select("doc_id").collect()} for _, _, a in stages]
    texts = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert ids[1] == {c for _, _, c in plain.groups(texts(stages[1][1]))}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert ids[2] == {i for i, _, h, _ in plain.contamination(texts(stages[2][1]), items) if not h}
    assert ids[3] == ids[2]
    for i, t in texts(stages[3][2]):
        assert plain.personal(t) == []
    assert ids[4] <= ids[3]
    taken = stages[4][2].agg(F.sum("taken")).first()[0]
    assert taken == pytest.approx(1.5 * sum(len(plain.words(t)) for _, t in texts(stages[4][1])), rel=0.01)


def test_pipeline_run_equals_stages(spark, stages):
    a = corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot", "from_word", "taken", "text").collect()
    b = stages[-1][2].select("doc_id", "shard", "slot", "from_word", "taken", "text").collect()
    assert sorted(a) == sorted(b)


def test_pipeline_takes_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")


def test_registered_and_not_imported_elsewhere():
    import __spark_entry__ as entry
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for d, _, names in os.walk(f"{root}/ledgerlake"):
        if not d.startswith(f"{root}/ledgerlake/llm"):
            for n in names:
                if n.endswith(".py"):
                    with open(f"{d}/{n}") as f:
                        assert "llm" not in f.read(), n


@pytest.mark.parametrize("name", ["op5_url_trust", "op6_decontaminate", "op8_secret_scan"])
def test_native_operators_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
