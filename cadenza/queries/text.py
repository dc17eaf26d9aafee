"""Q: n-gram, fuzzy and vibe search."""

from pyspark.sql import functions as F

from cadenza.functions.scalars import search_text
from cadenza.functions.text import strip, token_sort, token_sort_ratio
from cadenza.operators import tfidf, vibe
from cadenza.operators.clean import column_stats
from cadenza.plans import search as plan
from cadenza.queries.base import (
    FEATURES, FILLED, LEARNED, PHRASES, R, SEARCHES, TRACKS, feature_items, learned, query, rounded, searches,
    stripped, table, tracks,
)
from cadenza.queries.joins import KEYWORD_ROWS
from cadenza.queries.scalars import TITLE
from cadenza.session import write_and_read


def grams_sql(name, source, key, text):
    return f"""{name}_w AS (SELECT k, ' ' || w || ' ' AS w FROM (
  SELECT {key} AS k, unnest(string_split_regex(lower({text}), '\\s+')) AS w FROM {source}) WHERE w <> ''),
{name}_p AS (SELECT k, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM {name}_w, (VALUES (2), (3), (4)) AS ns(n)),
{name} AS (SELECT k, substr(w, CAST(i AS INTEGER), n) AS gram, count(*) AS tf FROM {name}_p GROUP BY 1, 2)"""


# corpus (id, text), its grams cg, document frequencies idf, unit-length weights dw
CORPUS = "corpus AS (SELECT id, lower(name || ' ' || artists) AS text FROM tracks)"


def fit_sql(source="corpus", key="id"):
    return grams_sql("cg", source, key, "text") + f""",
idf AS (SELECT gram, count(*) AS df, ln((1 + (SELECT count(*) FROM {source})) / (1 + count(*))) + 1 AS idf FROM cg GROUP BY gram),
dr AS (SELECT k, gram, (1 + ln(tf)) * idf AS w FROM cg JOIN idf USING (gram)),
dn AS (SELECT k, sqrt(sum(w * w)) AS norm, count(*) AS n FROM dr GROUP BY k),
dw AS (SELECT k, gram, w / norm AS w FROM dr JOIN dn USING (k))"""


def query_sql(source):
    return grams_sql("qg", source, "qid", "text") + """,
qr AS (SELECT k, gram, (1 + ln(tf)) * idf AS w FROM qg JOIN idf USING (gram)),
qw AS (SELECT k, gram, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS w FROM qr)"""


def _fitted(texts):
    """(vectors, vocabulary) of (id, text); the grams are counted once for both."""
    grams = tfidf.counted_grams(texts)
    idf = tfidf.fit_idf(texts, grams=grams)
    return tfidf.vectors(texts, idf, grams=grams), idf


def _corpus(spark, sf):
    return tracks(spark, sf).select("id", search_text(F.col("name"), F.col("artists")).alias("text"))


@query("q01_char_grams", "WITH " + TRACKS + ", " + CORPUS + ", " + grams_sql("cg", "corpus", "id", "text") + "SELECT k AS id, gram, tf FROM cg")
def q01(spark, sf):
    return rounded(tfidf.gram_counts(_corpus(spark, sf)))


@query("q01_char_grams_documents", "WITH " + grams_sql("cg", "documents", "doc_id", "text") + """
SELECT k AS doc_id, count(*) AS n_distinct, CAST(sum(tf) AS BIGINT) AS n_grams, CAST(max(tf) AS BIGINT) AS top FROM cg GROUP BY k""")
def q01_documents(spark, sf):
    grams = tfidf.gram_counts(table(spark, sf, "documents"), "doc_id", "text")
    return rounded(grams.groupBy("doc_id").agg(F.count("*").alias("n_distinct"), F.sum("tf").alias("n_grams"), F.max("tf").alias("top")))


@query("q02_idf", "WITH " + TRACKS + ", " + CORPUS + ", " + fit_sql() + f"SELECT gram, df, {R('idf')} AS idf FROM idf")
def q02_idf(spark, sf):
    return rounded(tfidf.fit_idf(_corpus(spark, sf)))


@query("q02_tfidf_weights", "WITH " + TRACKS + ", " + CORPUS + ", " + fit_sql() + f"SELECT k AS id, gram, {R('w')} AS weight FROM dw")
def q02(spark, sf):
    return rounded(tfidf.postings(_fitted(_corpus(spark, sf))[0]))


@query("q02_tfidf_documents", "WITH " + fit_sql("documents", "doc_id") + f"""
SELECT k AS doc_id, count(*) AS n, {R('max(w)')} AS top, {R('sum(w)')} AS total FROM dw GROUP BY k""")
def q02_documents(spark, sf):
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    # cut into grams twice: grams that are not written need not be brought together again
    rows = tfidf.vectors(texts, tfidf.fit_idf(texts, long=True), long=True)
    rows = rows.withColumnRenamed("id", "doc_id")
    return rounded(rows.select("doc_id", F.size("grams").alias("n"), F.array_max("weights").alias("top"),
                               F.aggregate("weights", F.lit(0.0), lambda a, w: a + w).alias("total")))


TFIDF_SCORES = """tfidf AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM (
    SELECT qw.k AS qid, dw.k AS id, sum(qw.w * dw.w) AS score FROM qw JOIN dw USING (gram) GROUP BY 1, 2) WHERE score > 0)"""


@query("q03_tfidf_search", "WITH " + SEARCHES + ", " + CORPUS + ", " + fit_sql() + ", " + query_sql("searches") + ", " + TFIDF_SCORES + f"""
SELECT qid, id, {R('score')} AS score, rank FROM tfidf WHERE rank <= 10""")
def q03(spark, sf):
    corpus = _corpus(spark, sf)
    index, idf = tfidf.fit_index(corpus)
    return rounded(tfidf.tfidf_top_k(corpus, searches(spark, sf), idf, 10, index=index))


@query("j08_query_gram_join", "WITH " + SEARCHES + ", " + CORPUS + ", " + fit_sql() + ", " + query_sql("searches") + ", " + TFIDF_SCORES + f"""
SELECT qid, id, {R('score')} AS score FROM tfidf""")
def j08(spark, sf):
    """All pairs of queries and items with a common gram, by a join of their postings."""
    rows, idf = _fitted(_corpus(spark, sf))
    return rounded(tfidf.query_gram_join(rows, searches(spark, sf), idf))


@query("q03_tfidf_search_documents", "WITH " + fit_sql("documents", "doc_id") + ", asked AS (SELECT item_id AS qid, text FROM benchmark), "
       + query_sql("asked") + ", " + TFIDF_SCORES + f"SELECT qid, id, {R('score')} AS score, rank FROM tfidf WHERE rank <= 5")
def q03_documents(spark, sf):
    """Whole passages looked up in whole documents."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return rounded(tfidf.scan_top_k(texts, asked, 5))


def lcs_sql(pairs):
    """Longest common subsequence per row of ``pairs`` (pk, a, b), one table row per step."""
    return f"""steps AS (
  SELECT pk, string_split(a, '') AS a, string_split(b, '') AS b, 0 AS j, list_transform(range(length(a) + 1), lambda x: 0) AS prev
  FROM {pairs} WHERE a <> '' AND b <> ''
  UNION ALL
  SELECT pk, a, b, j + 1, list_prepend(0, list_transform(range(1, len(cand) + 1), lambda i: list_max(cand[1:i]))) FROM (
    SELECT pk, a, b, j, list_transform(range(1, len(a) + 1), lambda i: greatest(prev[i + 1], prev[i] + CASE WHEN a[i] = b[j + 1] THEN 1 ELSE 0 END)) AS cand
    FROM steps WHERE j < len(b))),
lcs AS (SELECT pk, prev[len(prev)] AS common FROM steps WHERE j = len(b))"""


def sorted_sql(text):
    return f"array_to_string(list_sort(list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')), ' ')"


@query("q04_token_sort_ratio", "WITH RECURSIVE " + TRACKS + f""",
pairs AS (SELECT row_number() OVER () AS pk, a, b FROM (
  SELECT DISTINCT {sorted_sql("lower(name || ' ' || artists)")} AS a, {sorted_sql('all_genres')} AS b FROM tracks)),
""" + lcs_sql("pairs") + f"""
SELECT id, {R('200e0 * common / (length(a) + length(b))')} AS ratio FROM tracks
JOIN pairs ON a = {sorted_sql("lower(name || ' ' || artists)")} AND b = {sorted_sql('all_genres')} JOIN lcs USING (pk)""")
def q04(spark, sf):
    text = search_text(F.col("name"), F.col("artists"))
    return rounded(tracks(spark, sf).select("id", token_sort_ratio(text, F.col("all_genres")).alias("ratio")))


PHRASE_ROWS = "phrases AS (SELECT p AS qid, p AS text FROM (VALUES " + ", ".join(f"('{p}')" for p in PHRASES) + ") AS t(p))"


def fuzzy_sql(source):
    """fuzzy(qid, id, score, rank) of the rows of ``source`` (qid, text) against the corpus."""
    return f"""fq AS (SELECT qid, {sorted_sql('lower(text)')} AS a FROM {source}),
fd AS (SELECT DISTINCT {sorted_sql('text')} AS b FROM corpus),
pairs AS (SELECT row_number() OVER () AS pk, a, b FROM (SELECT DISTINCT a FROM fq), fd),
""" + lcs_sql("pairs") + f""",
fuzzy AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM (
  SELECT qid, id, 2e0 * common / (length(fq.a) + length(pairs.b)) AS score
  FROM fq JOIN pairs ON pairs.a = fq.a JOIN lcs USING (pk) JOIN corpus ON {sorted_sql('text')} = pairs.b))"""


@query("q05_fuzzy_search", "WITH RECURSIVE " + TRACKS + ", " + CORPUS + ", " + PHRASE_ROWS + ", " + fuzzy_sql("phrases") + f"""
SELECT qid, id, {R('score')} AS score, rank FROM fuzzy WHERE rank <= 10""")
def q05(spark, sf):
    asked = spark.createDataFrame([(p, p) for p in PHRASES], "qid string, text string")
    return rounded(tfidf.fuzzy_top_k(_corpus(spark, sf), asked, 10))


@query("q05_fuzzy_search_all", "WITH RECURSIVE " + SEARCHES + ", " + CORPUS + ", " + fuzzy_sql("searches") + f"""
SELECT qid, id, {R('score')} AS score, rank FROM fuzzy WHERE rank <= 5""")
def q05_all(spark, sf):
    """Every search text against the whole catalog."""
    asked = searches(spark, sf).filter(token_sort(F.col("text")) != "")
    return rounded(tfidf.fuzzy_top_k(_corpus(spark, sf), asked, 5))


# asked(qid, text, vibe): contained keyword first, else closest keyword at 80 or more
DETECT = KEYWORD_ROWS + f""",
exact AS (SELECT qid, any_value({stripped('text')}) AS text, arg_min(vibe, pos) AS vibe FROM searches
  LEFT JOIN keywords ON contains(lower({stripped('text')}), word) WHERE {stripped('text')} <> '' GROUP BY qid),
kq AS (SELECT qid, {sorted_sql('lower(text)')} AS a FROM exact WHERE vibe IS NULL),
kpairs AS (SELECT row_number() OVER () AS pk, qid, a, {sorted_sql('word')} AS b, pos, vibe FROM kq, keywords),
""" + lcs_sql("kpairs").replace("steps", "ksteps").replace("lcs", "klcs") + """,
close AS (SELECT qid, arg_min(vibe, (-ratio, pos)) AS vibe FROM (
  SELECT qid, pos, vibe, 200e0 * common / (length(a) + length(b)) AS ratio FROM kpairs JOIN klcs USING (pk)) WHERE ratio >= 80 GROUP BY qid),
asked AS (SELECT qid, text, coalesce(exact.vibe, close.vibe) AS vibe FROM exact LEFT JOIN close USING (qid))"""


@query("q06_detect_vibe", "WITH RECURSIVE " + SEARCHES + ", " + DETECT + "SELECT qid, vibe FROM asked")
def q06(spark, sf):
    asked = searches(spark, sf).filter(strip(F.col("text")) != "")
    return vibe.detect_vibe(asked).select("qid", "vibe")


TARGETS = "targets AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', {[float(t) for t in ts]})" for n, ts in vibe.VIBE_TARGETS.items()) + ") AS t(vibe, target))"


def vibe_sql(k):
    """by_vibe(vibe, id, score, rank): top k per profile."""
    return TARGETS + f""",
profiles AS (SELECT vibe, [{', '.join(f'(target[{i + 1}] - m_{c}) / s_{c}' for i, c in enumerate(FEATURES))}] AS vec FROM targets, st),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vibe ORDER BY round(ip, 9) DESC, id) AS r FROM (
  SELECT vibe, id, popularity, CAST(list_inner_product(p.vec, i.vec) AS DOUBLE) AS ip FROM profiles p, items i)) WHERE r <= {20 * k}),
ends AS (SELECT *, min(ip) OVER w AS ip0, max(ip) OVER w AS ip1, min(popularity) OVER w AS p0, max(popularity) OVER w AS p1
  FROM near WINDOW w AS (PARTITION BY vibe)),
by_vibe AS (SELECT * FROM (SELECT vibe, id, score, row_number() OVER (PARTITION BY vibe ORDER BY round(score, 9) DESC, id) AS rank FROM (
  SELECT vibe, id, (CASE WHEN ip1 > ip0 THEN (ip - ip0) / (ip1 - ip0) ELSE 1e0 END * 0.8e0
    + CASE WHEN p1 > p0 THEN (popularity - p0) / (p1 - p0) ELSE 1e0 END * 0.2e0) AS score FROM ends)) WHERE rank <= {k})"""


@query("q07_vibe_search", "WITH " + FILLED + ", " + vibe_sql(8) + f"SELECT vibe, id, rank, {R('score')} AS score FROM by_vibe")
def q07(spark, sf):
    filled = tracks(spark, sf).fillna(0.0, subset=FEATURES)
    profiles = vibe.profile_vectors(spark, FEATURES, column_stats(filled, FEATURES))
    got = vibe.vibe_results(feature_items(spark, sf), profiles, 8)
    return rounded(got.select("vibe", "id", "rank", F.col("_search_score").alias("score")))


# searches and filled both start from tracks
BOTH = SEARCHES + FILLED[len(TRACKS):]
K = 8
FOUND = BOTH + ", " + CORPUS + ", " + DETECT + ", " + vibe_sql(K) + ", " + fit_sql() + """,
typed AS (SELECT qid, text FROM asked WHERE vibe IS NULL), """ + query_sql("typed") + ", " + TFIDF_SCORES + """,
sure AS (SELECT qid FROM tfidf WHERE rank = 1 AND score >= 0.10),
unsure AS (SELECT * FROM typed WHERE qid NOT IN (SELECT qid FROM sure)), """ + fuzzy_sql("unsure") + f""",
textual AS (SELECT qid, id, rank, score, 'tfidf' AS mode FROM tfidf JOIN sure USING (qid) WHERE rank <= {K}
  UNION ALL SELECT qid, id, rank, score, 'fuzzy' FROM fuzzy WHERE rank <= {K}),
found AS (
  SELECT qid, id, rank, score, 'vibe' AS mode, 'Vibe: *' || {TITLE.format(t='text')} || '*' AS label FROM asked JOIN by_vibe USING (vibe)
  UNION ALL
  SELECT t.qid, t.id, t.rank, t.score, t.mode, '**' || n.name || '** by ' || n.artists
  FROM textual t JOIN (SELECT qid, name, artists FROM textual JOIN tracks USING (id) WHERE rank = 1) n USING (qid))"""


@query("q08_search", "WITH RECURSIVE " + FOUND + f"SELECT qid, id, name, rank, {R('score')} AS score, mode, label FROM found JOIN tracks USING (id)")
def q08(spark, sf):
    index = plan.build_search_index(tracks(spark, sf))
    got = plan.search(index, searches(spark, sf), K)
    return rounded(got.select("qid", "id", "name", "rank", F.col("_search_score").alias("score"), "mode", "label"))


@query("q08_query_modes", "WITH RECURSIVE " + FOUND + """
SELECT searches.qid, coalesce(mode, 'none') AS mode, coalesce(label, 'Empty query') AS label
FROM searches LEFT JOIN (SELECT * FROM found WHERE rank = 1) USING (qid)""")
def q08_modes(spark, sf):
    index = plan.build_search_index(tracks(spark, sf))
    asked = searches(spark, sf)
    return plan.query_modes(asked, plan.search(index, asked, K))


RECOMMENDED = FOUND + f""",
seeds AS (SELECT qid, id AS seed_id, mode, label FROM found WHERE rank = 1 AND mode <> 'vibe'),
cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY round(sim, 9) DESC, id) AS r FROM (
  SELECT q.id AS sid, i.id, i.popularity, CAST(list_inner_product(q.vec, i.vec) AS DOUBLE) AS sim
  FROM items q JOIN items i ON q.id <> i.id WHERE q.id IN (SELECT seed_id FROM seeds))) WHERE r <= {K}),
recs AS (SELECT sid, id, sim, final, row_number() OVER (PARTITION BY sid ORDER BY round(final, 9) DESC, id) AS rank FROM (
  SELECT *, sim * 0.7e0 + popularity / 100e0 * 0.3e0 AS final FROM cand)),
answers AS (
  SELECT qid, seed_id, rank, id, sim, final, mode, label FROM seeds JOIN recs ON sid = seed_id
  UNION ALL SELECT qid, NULL, rank, id, NULL, score, mode, label FROM found WHERE mode = 'vibe')"""


@query("q09_search_and_recommend", "WITH RECURSIVE " + RECOMMENDED + f"""
SELECT qid, seed_id, rank, id, {R('sim')} AS similarity_score, {R('final')} AS final_score, mode, label FROM answers""")
def q09(spark, sf):
    index = plan.build_search_index(tracks(spark, sf))
    got = plan.search_and_recommend(index, searches(spark, sf), K)
    return rounded(got.select("qid", "seed_id", "rank", "id", "similarity_score", "final_score", "mode", "label"))


def hybrid_sql(source, queries, k, alpha="0.7e0", beta="0.2e0", gamma="0.1e0", own="id"):
    """hybrid(qid, id, rank, ...) for ``queries`` (id, vec) over ``source`` (id, artists, popularity, vec)."""
    return f"""hp AS (SELECT min(popularity) AS lo, max(popularity) AS hi FROM {source}),
hc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sim, 9) DESC, id) AS r FROM (
  SELECT q.id AS qid, i.id, i.artists, (i.popularity - lo) / (hi - lo + 1e-8) AS pop, CAST(list_inner_product(q.vec, i.vec) AS DOUBLE) AS sim
  FROM {queries} q, {source} i, hp)) WHERE r <= {10 * k + 1} AND qid <> {own}),
hn AS (SELECT *, CASE WHEN max(sim) OVER w > min(sim) OVER w THEN (sim - min(sim) OVER w) / (max(sim) OVER w - min(sim) OVER w) ELSE 1e0 END AS sn
  FROM hc WINDOW w AS (PARTITION BY qid)),
hb AS (SELECT *, {alpha} * sn + {beta} * pop AS base FROM hn),
hr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(base, 9) DESC, id) AS rank,
  1e0 / (1e0 + row_number() OVER (PARTITION BY qid, artists ORDER BY round(base, 9) DESC, id) - 1) AS bonus FROM hb),
hybrid AS (SELECT qid, id, rank, round_even(base + {gamma} * bonus, 4) AS final_score, round_even(sn, 4) AS sim_score,
  round_even(pop, 4) AS pop_score, round_even(bonus, 4) AS diversity_bonus FROM hr WHERE rank <= {k})"""


SERVED = RECOMMENDED + ", " + LEARNED[len(TRACKS) + 1:] + """,
hq AS (SELECT DISTINCT learned.id, learned.vec FROM learned JOIN seeds ON seed_id = learned.id), """ + hybrid_sql("learned", "hq", K) + """,
shown AS (
  SELECT seeds.qid, 'hybrid' AS mode, label, 'two-tower hybrid' AS engine_name, h.rank, h.id, h.sim_score AS similarity, 0e0 AS energy,
    'ranked highly by the two-tower hybrid scorer (' || format('{:.3f}', final_score) || ') | strong vector similarity to the seed track ('
    || format('{:.3f}', sim_score) || ') | popularity signal contributed ' || format('{:.2f}', pop_score) || ' | artist diversity bonus '
    || format('{:.2f}', diversity_bonus) AS reasons
  FROM seeds JOIN hybrid h ON h.qid = seed_id
  UNION ALL
  SELECT qid, mode, label, 'FAISS fallback', rank, a.id, sim, 0e0,
    'ranked highly by the FAISS fallback scorer (' || format('{:.3f}', final) || ') | strong vector similarity to the seed track ('
    || format('{:.3f}', sim) || ') | popularity is ' || format('{:.1f}', popularity)
  FROM answers a JOIN tracks USING (id) WHERE seed_id IS NOT NULL AND seed_id NOT IN (SELECT id FROM hq)
  UNION ALL
  SELECT qid, mode, label, 'FAISS', rank, a.id, final, coalesce(energy, 0),
    'ranked highly by the FAISS scorer (' || format('{:.3f}', final) || ') | matches the requested vibe profile | popularity is '
    || format('{:.1f}', popularity) || ' | ' || CASE WHEN coalesce(energy, 0) >= 0.65e0 THEN 'high energy' WHEN coalesce(energy, 0) <= -0.65e0 THEN 'low energy' ELSE 'balanced energy' END
  FROM answers a JOIN tracks USING (id) WHERE seed_id IS NULL)"""


@query("q10_display_rows", "WITH RECURSIVE " + SERVED + f"""
SELECT qid, mode, label, engine_name, rank, s.id, t.name, t.artists AS artist, {R('similarity')} AS similarity, {R('s.energy')} AS energy, reasons
FROM shown s JOIN tracks t USING (id)""")
def q10_display(spark, sf):
    index = plan.build_search_index(tracks(spark, sf))
    hybrid = write_and_read(learned(spark, sf), "learned")
    shown = plan.display(plan.search_service(index, searches(spark, sf), K, hybrid))
    return rounded(shown.select("qid", "mode", "label", "engine_name", "rank", "id", "name", "artist", "similarity", "energy",
                                F.array_join("reasons", " | ").alias("reasons")))


@query("q10_search_service", "WITH RECURSIVE " + RECOMMENDED + ", " + LEARNED[len(TRACKS) + 1:] + """,
hq AS (SELECT DISTINCT learned.id, learned.vec FROM learned JOIN seeds ON seed_id = learned.id), """ + hybrid_sql("learned", "hq", K) + f"""
SELECT seeds.qid, 'hybrid' AS mode, label, 'two-tower hybrid' AS engine_name, hybrid.rank, hybrid.id, {R('final_score')} AS final_score
FROM seeds JOIN hybrid ON hybrid.qid = seed_id
UNION ALL
SELECT qid, mode, label, CASE WHEN seed_id IS NULL THEN 'FAISS' ELSE 'FAISS fallback' END, rank, id, {R('final')}
FROM answers WHERE seed_id IS NULL OR seed_id NOT IN (SELECT id FROM hq)""")
def q10(spark, sf):
    index = plan.build_search_index(tracks(spark, sf))
    hybrid = write_and_read(learned(spark, sf), "learned")
    got = plan.search_service(index, searches(spark, sf), K, hybrid)
    return rounded(got.select("qid", "mode", "label", "engine_name", "rank", "id", "final_score"))
