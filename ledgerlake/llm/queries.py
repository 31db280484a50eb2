"""The registered queries of the training-data operators and their SQL.

Every query applies one operator, with its production parameters, to the whole
of its table and keeps the digest columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (collocations, conversation_repair, decontaminate, llr_quality, mixing, ngram_join, pii, quality_classifier,
                            secret_scan, substring_dedup, token_counts, token_files, url_trust)
from ledgerlake.llm.scratch import stored
from ledgerlake.sources.tables import run_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mixed_amounts(_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op2_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = llr_quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(quality_classifier.document_statistics(docs).drop("text"), "statistics")
    model = quality_classifier.fit(stats, _table(spark, sf_dir, "labels"))
    return quality_classifier.score(stats, model)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                                       F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_trust.judge_pages(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
            .select("page_id", "host", "path", "rule", "verdict"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """``vocabulary``: path of the vocabulary file; the public word_bpe_49k.json if none is given."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_counts.token_prefixes(docs, vocabulary, keep_text=False)
    n = F.element_at("prefix_tokens", -1).cast("long")
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def _listing(spans: str, kinds=None) -> F.Column:
    """kind:start:end of the spans, comma-joined in their order."""
    col = F.col(spans)
    if kinds:
        col = F.filter(col, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _n_kind(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secret_scan.BASE]
    return found.select("doc_id", *[_n_kind("spans", k).alias(f"n_{k}") for k in base],
                        F.sha2(_listing("spans", base), 256).alias("base_sha256"), _listing("spans").alias("spans"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(pii.candidates(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "candidates")
    spans = pii.accept(found, pii.fit(found))
    return spans.select("doc_id", *[_n_kind("spans", k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(_listing("spans", pii.BASE), 256).alias("base_sha256"), _listing("spans").alias("spans"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(conversation_repair.damage(_table(spark, sf_dir, "conversations")))


def op12_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """``vocabulary``: path of the vocabulary file; the public word_bpe_49k.json if none is given."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = f"{run_folder(spark)}/token-files"
    token_files.write_ids(_table(spark, sf_dir, "documents"), vocabulary, path)
    return token_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_llr_quality, op3_substring_dedup, op4_ngram_join, op5_url_trust, op6_decontaminate,
    op7_token_counts, op8_secret_scan, op9_quality_classifier, op10_pii, op11_conversation_repair, op12_token_files,
    op13_collocations)}
_BLANK = r"[^\x20\x09-\x0D]+"

# Fixed values of the SQL forms, written out here and not taken from the operators.
_SECRETS = (  # kind, pattern, group measured, least length; letters of either case: the other engine folds beyond ASCII
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0),
    ("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    ("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
)
_URL_RULES = (("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
              ("com", "/de/", "block"), ("org", "/", "allow"))  # the longest first
_LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""
# End of the fixed values.


def _span_sql() -> str:
    """The secret rules in DuckDB: matches are marked, and places add up between the marks."""
    parts = []
    for i, (kind, pattern, group, least) in enumerate(_SECRETS):
        pattern = pattern.replace("'", "''")
        size = f"length(regexp_extract(part, '{pattern}', {group}))"
        parts.append(f"""
            SELECT doc_id, {i} AS o, '{kind}' AS kind, pos, pos + length(part) AS fin FROM (
                SELECT doc_id, part, k, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY k
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
                FROM (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS k FROM (
                      SELECT doc_id, string_split(regexp_replace(replace(coalesce(text, ''), chr(1), chr(2)),
                             '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents)))
            WHERE k % 2 = 0 AND {size} >= {least}""")
    listed = "string_agg(kind || ':' || pos || ':' || fin, ',' ORDER BY pos, o)"
    return f"""WITH spans AS ({" UNION ALL ".join(parts)}),
        found AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                  count(*) FILTER (kind = 'hex') AS n_hex, {listed} FILTER (kind IN ('assign', 'access', 'hex')) AS base, {listed} AS listed
                  FROM spans GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
               coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(listed, '') AS spans
        FROM documents LEFT JOIN found USING (doc_id)"""


def _trust_sql() -> str:
    """The propagation with its 8 rounds written out, rounded to 12 significant digits after each."""
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    pick = lambda of: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{of(h, p, v)}'" for h, p, v in _URL_RULES) + " END"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    digits = "format('{{:.11e}}', {})::DOUBLE".format
    link = _LINK.replace("'", "''")
    steps, last = [], "s0"
    for k in range(1, 9):
        t, d = (digits(f"(0.15 * h.{c}0 + 0.85 * coalesce(x.{c}, 0))::DOUBLE") for c in "td")
        steps.append(f"""s{k} AS (SELECT h.host, {t} AS t, {d} AS d
            FROM s0 h LEFT JOIN (SELECT host, sum(t) AS t, sum(d) AS d FROM (
                SELECT dst AS host, s.t * w_out AS t, 0.0 AS d FROM weighted JOIN {last} s ON src = s.host
                UNION ALL SELECT src, 0.0, s.d * w_in FROM weighted JOIN {last} s ON dst = s.host) GROUP BY host) x
            ON x.host = h.host)""")
        last = f"s{k}"
    return f"""WITH named AS (SELECT page_id, html, {lower("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
            regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        ruled AS (SELECT *, {pick(lambda h, p, v: h + p)} AS rule, {pick(lambda h, p, v: v)} AS fixed FROM named),
        edges AS (SELECT src, dst, count(*) AS n FROM (
            SELECT host AS src, {lower(f"unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1))")} AS dst FROM named)
            WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
        weighted AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w_out,
                     n / sum(n) OVER (PARTITION BY dst) AS w_in FROM edges),
        seeds AS (SELECT host, count(*) FILTER (fixed = 'allow') AS good, count(*) FILTER (fixed = 'block') AS bad
                  FROM ruled WHERE host <> '' GROUP BY host),
        hosts AS (SELECT host FROM seeds UNION SELECT src FROM edges UNION SELECT dst FROM edges),
        s0 AS (SELECT host, t0, d0, t0 AS t, d0 AS d FROM (
               SELECT host, coalesce(good / nullif((SELECT sum(good) FROM seeds), 0), 0) AS t0,
                      coalesce(bad / nullif((SELECT sum(bad) FROM seeds), 0), 0) AS d0
               FROM hosts LEFT JOIN seeds USING (host))),
        {", ".join(steps)}
        SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN coalesce(d, 0) > 0
               AND coalesce(d, 0) >= 2 * coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled LEFT JOIN {last} USING (host)"""


def _repair_sql() -> str:
    """Cheapest and least edits by going forward through the rows with one best path for each state; a
    path is its cost in six digits and its edits, so that text order is the order wanted."""
    add = lambda s, cost, edit: f"lpad((left({s}, 6)::INTEGER + ({cost}))::VARCHAR, 6, '0') || substr({s}, 7) || '{edit}'"
    ends = f"least(s0, s3, {add('s2', 3, 'I')}, {add('s1', 6, 'II')})"
    blank, last = r"'[^\x20\x09-\x0D]'", r"'([^\x20\x09-\x0D])[\x20\x09-\x0D]*$'"
    kept = lambda s, cost, when: f"CASE WHEN fault < 2 AND {when} THEN {add(s, f'{cost} + 3 * fault', 'K' if not cost else 'R')} END"
    return rf"""
        WITH RECURSIVE keyed AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn, coalesce(role, ' ') AS role,
                coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
        hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(key, ''),
                lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 20 AS kind FROM keyed),
        damaged AS (SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
                WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
                FROM hashed),
        marked AS (SELECT *, row_number() OVER w AS i, NOT regexp_matches(text, {blank}) AS blank,
                row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, left(role, 1) AS ini,
                lag(left(role, 1)) OVER w AS before, regexp_extract(text, {last}, 1) NOT IN ('.', '!', '?') AS cut
                FROM damaged WINDOW w AS (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
        judged AS (SELECT *, CASE WHEN blank OR again THEN 2 WHEN cut THEN 1 ELSE 0 END AS fault FROM marked),
        counts AS (SELECT g, max(i) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
                count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal,
                coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM judged GROUP BY g),
        steps AS (SELECT g, 0::BIGINT AS i, '000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM counts
            UNION ALL
            SELECT g, i, {add('s0', 4, 'D')}, least({add('s1', 4, 'D')}, {kept('s0', 0, "ini = 's'")}),
                least({add('t2', 4, 'D')}, {", ".join(kept(s, c, w) for s in ('s0', 's1', 't3') for c, w in ((0, "ini = 'u'"), (3, "ini <> 'u'")))}),
                least({add('t3', 4, 'D')}, {", ".join(kept('t2', c, w) for c, w in ((0, "ini = 'a'"), (3, "ini <> 'a'")))})
            FROM (SELECT g, j.i, s0, s1, fault, ini, least(s2, {add('s0', 3, 'I')}, {add('s1', 3, 'I')}, {add('s3', 3, 'I')}) AS t2,
                  least(s3, {add('s2', 3, 'I')}, {add('s0', 6, 'II')}, {add('s1', 6, 'II')}) AS t3
                  FROM steps JOIN judged j USING (g) WHERE j.i = steps.i + 1)),
        ended AS (SELECT g, left(x, 6)::BIGINT AS cost, substr(x, 7) AS audit FROM (SELECT g, {ends} AS x FROM steps JOIN counts USING (g) WHERE i = n)),
        edits AS (SELECT g, k, edit, sum((edit <> 'I')::INTEGER) OVER (PARTITION BY g ORDER BY k) AS i FROM (
                  SELECT g, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS k FROM ended WHERE audit <> '')),
        stay AS (SELECT e.g, k, edit, role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, edit = 'K' AND ini = 's' AS opens
                 FROM edits e LEFT JOIN judged j ON j.g = e.g AND j.i = e.i WHERE edit <> 'D'),
        said AS (SELECT g, k, text, CASE WHEN edit = 'K' THEN role WHEN sum((NOT coalesce(opens, false))::INTEGER) OVER (PARTITION BY g ORDER BY k) % 2 = 1
                 THEN 'user' ELSE 'assistant' END AS role FROM stay),
        repaired AS (SELECT g, string_agg(role || ':' || text, chr(10) ORDER BY k) AS body FROM said GROUP BY g)
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT g, conv_id FROM keyed) LEFT JOIN counts USING (g) LEFT JOIN ended USING (g) LEFT JOIN repaired USING (g)"""


# Plain forms of the operators' results, for DuckDB.
ORACLE: dict[str, str] = {
    "op3_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
                    FROM d, unnest(range(1, len(w) - 18)) AS r(i) WHERE len(w) >= 20),
        again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, i + k AS p FROM again, unnest(range(0, 20)) AS r(k)),
        places AS (SELECT doc_id, i AS p, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS r(i)),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS txt, count(*) AS n
                 FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(txt, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_ngram_join": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '{_BLANK}') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
              FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b USING (g)
                  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                  WHERE 100 * o >= 75 * (x.n + y.n - o)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id""",
    "op6_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
               FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
        dw AS (SELECT doc_id, i, s.n, array_to_string(w[i:i + s.n - 1], ' ') AS win
               FROM d, (SELECT DISTINCT n FROM bw) s, unnest(range(1, len(w) - s.n + 2)) AS r(i)),
        hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win, n)),
        cover AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS r(k) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_url_trust": _trust_sql(),
    "op8_secret_scan": _span_sql(),
    "op11_conversation_repair": _repair_sql(),
    "op13_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
            SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
        total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
        f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
              FROM pieces, (SELECT unnest(range(1, 6)) AS m) s, unnest(range(1, len(w) - m + 2)) AS r(i) GROUP BY ALL HAVING count(*) >= 100),
        kept AS (SELECT * FROM f p WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM f q WHERE q.lang = p.lang AND q.m > p.m
                 AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ') AND 100 * q.f >= 100 * p.f)),
        cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
                 array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest FROM kept, unnest(range(1, m)) AS r(k)),
        scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n::BIGINT AS n,
                   ((1000::HUGEINT * a * n::BIGINT) // (x.f::HUGEINT * y.f))::BIGINT AS score
                   FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = rest
                   JOIN total t ON t.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000""",
}
