"""SQL for DuckDB that gives the result of each registered query by other means.

Iterative models and Spark's own samplers have no SQL; the tests check their properties.
"""

from __future__ import annotations

from lexloom import queries as q


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _quoted(text: str) -> str:
    return text.replace("'", "''")


def _bucket(*keys: str, purpose: str, seed: int = q.SEED) -> str:
    """The first 32 bits of a digest, as a share of their range."""
    parts = ", ".join(f"coalesce(cast({k} AS VARCHAR), '')" for k in keys)
    digest = f"md5(concat_ws(':', '{purpose}', '{seed}', {parts}))"
    number = f"cast('0x' || substr({digest}, 1, 8) AS BIGINT)"
    return f"({number} / cast(4294967296 AS DOUBLE))"


def _copies(u: str, mean: float) -> str:
    """The number of n for which a Poisson variable is at most n with probability u or less."""
    at_most = f"""list_sum(list_transform(range(0, n + 1),
        lambda i: exp(-cast({mean} AS DOUBLE)) * pow(cast({mean} AS DOUBLE), i) / factorial(i::INT)))"""
    return f"len(list_filter(range(0, 20), lambda n: {at_most} <= {u}))"


_SAMPLED = f"""{_bucket('doc_id', purpose='sample')} < cast(
    CASE source {' '.join(f"WHEN '{s}' THEN {f}" for s, f in q.SLICE_FRACTIONS.items())}
    ELSE {q.REST_FRACTION} END AS DOUBLE)"""
_TRAIN = f"{_bucket('doc_id', purpose='split')} < cast({q.TRAIN_SHARE} AS DOUBLE)"


def _tokens(text: str, min_length: int, stop_words=()) -> str:
    stop = f" AND x NOT IN ({_list(stop_words)})" if stop_words else ""
    split = rf"regexp_split_to_array(lower({text}), '[^\p{{L}}]+')"
    return f"list_filter({split}, lambda x: length(x) >= {min_length}{stop})"


def _docs(stop_words=q.STOP_WORDS, source: str = "documents") -> str:
    return f"""docs AS (
        SELECT *
        FROM (SELECT *, {_tokens('text', q.MIN_LENGTH, stop_words)} AS tokens FROM {source})
        WHERE len(tokens) >= 2)"""


def _vocabulary(key: str, max_df: float, size: int) -> str:
    """From `docs`: counts (key, term, tf), n (n), vocab (term, term_id, ctf, df, idf)."""
    return f"""
    counts AS (
        SELECT {key}, term, count(*) AS tf
        FROM (SELECT {key}, unnest(tokens) AS term FROM docs) GROUP BY {key}, term),
    n AS (SELECT count(DISTINCT {key}) AS n FROM docs),
    stats AS (
        SELECT term, cast(sum(tf) AS BIGINT) AS ctf, count(*) AS df FROM counts GROUP BY term),
    vocab AS (
        SELECT term, cast(row_number() OVER (ORDER BY ctf DESC, term) - 1 AS INT) AS term_id,
               ctf, df, ln((n + 1.0) / (df + 1.0)) AS idf
        FROM stats, n WHERE df <= cast({max_df} AS DOUBLE) * n
        ORDER BY ctf DESC, term LIMIT {size})"""


def _naive_bayes(label: str, source: str) -> str:
    """predictions (doc_id, label, prediction) in closed form."""
    return f"""
    WITH {_docs(source=source)}, {_vocabulary('doc_id', 0.5, 5000)},
    labelled AS (
        SELECT doc_id, cast({label} AS VARCHAR) AS label,
               {_TRAIN} AS train FROM docs),
    weights AS (SELECT doc_id, term, tf * idf AS w FROM counts JOIN vocab USING (term)),
    order_of AS (
        SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) AS i
        FROM labelled GROUP BY label),
    prior AS (
        SELECT label, ln(count(*) + 1.0) AS p FROM labelled WHERE train GROUP BY label),
    sums AS (
        SELECT label, term, sum(w) AS s FROM weights JOIN labelled USING (doc_id)
        WHERE train GROUP BY label, term),
    totals AS (SELECT label, sum(s) AS s FROM sums GROUP BY label),
    theta AS (
        SELECT p.label, v.term,
               ln(coalesce(s.s, 0) + 1.0) - ln(t.s + (SELECT count(*) FROM vocab)) AS x
        FROM prior p CROSS JOIN vocab v JOIN totals t ON t.label = p.label
        LEFT JOIN sums s ON s.label = p.label AND s.term = v.term),
    parts AS (
        SELECT l.doc_id, t.label, sum(w.w * t.x) AS x
        FROM labelled l JOIN weights w USING (doc_id) JOIN theta t USING (term)
        WHERE NOT l.train GROUP BY l.doc_id, t.label),
    scores AS (
        SELECT l.doc_id, l.label AS actual, p.label, p.p + coalesce(x.x, 0) AS score
        FROM labelled l CROSS JOIN prior p
        LEFT JOIN parts x ON x.doc_id = l.doc_id AND x.label = p.label WHERE NOT l.train),
    predictions AS (
        SELECT doc_id, actual AS label, label AS prediction
        FROM scores JOIN order_of USING (label)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) = 1)"""


# From `predictions` (label, prediction) the averaged f1 and the accuracy.
_F1 = """
    classes AS (
        SELECT c, (SELECT count(*) FROM predictions WHERE label = c) AS actual,
               (SELECT count(*) FROM predictions WHERE prediction = c) AS predicted,
               (SELECT count(*) FROM predictions WHERE label = c AND prediction = c) AS hits
        FROM (SELECT label AS c FROM predictions UNION SELECT prediction FROM predictions))
    SELECT cast(sum(actual) AS BIGINT) AS n,
           round(sum(hits) / cast(sum(actual) AS DOUBLE), 6) AS accuracy,
           round(sum(actual * 2.0 * hits / (actual + predicted)) / cast(sum(actual) AS DOUBLE), 6)
               AS f1
    FROM classes"""

_DRAWN = f"""
    drawn AS (
        SELECT * FROM (
            SELECT *, unnest(generate_series(1,
                {_copies(_bucket('conv_id', 'turn', purpose='copies'), q.DRAW_RATE)})) AS copy
            FROM conversations)
        ORDER BY conv_id, turn, copy LIMIT {q.DRAW_LIMIT})"""

_LONG_VECTORS = """
    values_of AS (
        SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS i,
               cast(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""



def _periods(during: tuple = q.DURING) -> str:
    return f"""
    WITH {_LONG_VECTORS},
    sides AS (
        SELECT label, i,
               max(value) FILTER (WHERE vec_id % 2 BETWEEN {q.PRE[0]} AND {q.PRE[1]}) AS pre,
               max(value) FILTER (WHERE vec_id % 2 BETWEEN {during[0]} AND {during[1]}) AS during
        FROM values_of GROUP BY label, i)"""


_COSINE = "sum(pre * during) / (sqrt(sum(pre * pre)) * sqrt(sum(during * during)))"


def _missing(column: str, text: bool = False) -> str:
    test = f"{column} IS NULL"
    if text:
        test += f" OR contains({column}, 'NULL') OR contains({column}, 'null')"
    return f"count(*) FILTER (WHERE {test}) AS {column}"


def _drift(where: str = "") -> str:
    return f"""{_periods()}
    SELECT label, round({_COSINE}, 6) AS similarity FROM sides {where}
    GROUP BY label HAVING count(pre) > 0 AND count(during) > 0"""


def _overall(during: tuple = q.DURING) -> str:
    return f"""{_periods(during)},
        overall AS (SELECT i, max(pre) AS pre, max(during) AS during FROM sides GROUP BY i)
        SELECT round(sqrt(sum((pre - during) * (pre - during))), 6) AS euclidean_distance,
               round(1 - {_COSINE}, 6) + 0.0 AS cosine_distance FROM overall"""


def _pooled(aggregate: str, key: str) -> str:
    key = f"{key}, " if key else ""
    return f"""WITH {_LONG_VECTORS}
    SELECT {key}cast(i AS INT) AS i, round({aggregate}(value), 6) + 0.0 AS value
    FROM values_of GROUP BY {key}i"""


def _nearest(vectors: str, key: str, k: int) -> str:
    """Brute force over all pairs of `vectors` (key, v)."""
    return f"""WITH {vectors},
    pairs AS (
        SELECT a.{key}, b.{key} AS other, round(list_cosine_similarity(a.v, b.v), 9) AS s
        FROM vectors a JOIN vectors b ON a.{key} <> b.{key}),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, other) AS rank FROM pairs)
    SELECT {key}, other, round(s, 6) + 0.0 AS similarity, cast(rank AS INT) AS rank
    FROM ranked WHERE rank <= {k}"""


SQL: dict[str, str] = {
    "parquet_scan": "SELECT doc_id, lang, source, n_chars FROM documents",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}"
        for t in ("documents", "labels", "embeddings", "conversations", "events", "orders")
    ),
    "directory_slices": """
        SELECT lang, count(*) AS n, cast(sum(n_chars) AS BIGINT) AS n_chars,
               true AS slices_are_files
        FROM documents GROUP BY lang""",
    "csv_round_trip": "SELECT doc_id, md5(text) AS text_md5, lang, source FROM documents",
    "json_append": "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents",
    "stop_list_removal": f"""
        WITH {_docs(())},
        words AS (
            SELECT term FROM (SELECT unnest(tokens) AS term FROM docs)
            GROUP BY term ORDER BY count(*) DESC, term LIMIT 50),
        kept AS (
            SELECT doc_id, count(*) AS n_tokens
            FROM (SELECT doc_id, unnest(tokens) AS term FROM docs)
            WHERE term NOT IN (SELECT term FROM words) GROUP BY doc_id)
        SELECT doc_id, n_tokens FROM kept WHERE n_tokens >= 2""",
    "listed_terms_dropped": f"""
        WITH {_docs(())},
        counts AS (
            SELECT lang, token, count(*) AS n
            FROM (SELECT lang, unnest(tokens) AS token FROM docs) GROUP BY lang, token),
        words AS (
            SELECT token FROM counts GROUP BY token ORDER BY sum(n) DESC, token LIMIT 50)
        SELECT lang, token, n FROM counts WHERE token NOT IN (SELECT token FROM words)""",
    "marker_rows": """
        SELECT doc_id, lang, source, n_chars FROM documents
        WHERE contains(source, 'c1') AND lang IN ('en', 'fr') AND n_chars BETWEEN 100 AND 5000""",
    "complete_labels": """
        SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)
        WHERE quality IS NOT NULL""",
    "shrunk_text": r"""
        SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text_md5
        FROM documents""",
    "joined_tokens": f"""
        WITH {_docs()}
        SELECT doc_id, md5(array_to_string(tokens, ',')) AS line_md5, len(tokens) AS n_tokens
        FROM docs""",
    "cleaned_arrays": f"""
        WITH arrays AS (
            SELECT doc_id, CASE WHEN doc_id % 10 = 1 THEN [] ELSE string_split(text, ' ') END AS x
            FROM documents WHERE doc_id % 10 <> 0),
        kept AS (
            SELECT doc_id, list_filter(x, lambda t: length(t) >= {q.MIN_LENGTH}
                AND lower(t) NOT IN ({_list(q.STOP_WORDS)})) AS tokens,
                list_filter(list_transform(x, lambda t: lower(t)),
                    lambda t: length(t) >= {q.MIN_LENGTH}) AS lowered
            FROM arrays)
        SELECT doc_id, len(tokens) AS n_tokens, md5(array_to_string(tokens, '|')) AS tokens_md5,
               md5(array_to_string(lowered, '|')) AS lowered_md5
        FROM kept WHERE len(tokens) >= 2""",
    "token_counts": f"""
        WITH {_docs()}
        SELECT term, count(*) AS ctf, count(DISTINCT doc_id) AS df
        FROM (SELECT doc_id, unnest(tokens) AS term FROM docs) GROUP BY term""",
    "period_numbers": """
        WITH numbered AS (
            SELECT role, try_cast(replace(
                CASE WHEN role = 'assistant' THEN 'period review ' ELSE 'period ' END || turn,
                'period', '') AS INT) AS number
            FROM conversations)
        SELECT role, number, count(*) AS n FROM numbered GROUP BY role, number""",
    "years": """
        WITH text_days AS (
            SELECT o_orderstatus,
                CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
                ELSE strftime(o_orderdate, '%d/%m/%Y') END AS s FROM orders),
        days AS (SELECT o_orderstatus, try_strptime(s, '%d/%m/%Y') AS day FROM text_days)
        SELECT o_orderstatus, cast(year(day) AS INT) AS year, count(*) AS n,
               strftime(max(day), '%Y-%m-%d') AS last
        FROM days WHERE year(day) BETWEEN 1996 AND 1999 GROUP BY o_orderstatus, year(day)""",
    "null_profile": f"""
        SELECT {_missing('event_id')}, {_missing('ts')}, {_missing('user_id')},
               {_missing('event_type', True)}, {_missing('value')}, {_missing('props', True)}
        FROM events""",
    "null_profile_joined": f"""
        SELECT {_missing('doc_id')}, {_missing('text', True)}, {_missing('lang', True)},
               {_missing('quality')}, {_missing('toxic')}
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "sample_rows": f"""
        SELECT doc_id, lang FROM documents
        WHERE {_bucket('doc_id', purpose='sample')} < cast(0.3 AS DOUBLE)""",
    "sample_with_replacement": f"""
        SELECT doc_id, lang, cast(unnest(generate_series(1,
            {_copies(_bucket('doc_id', purpose='copies'), 0.8)})) AS INT) AS copy
        FROM documents""",
    "sample_slices": f"""
        SELECT doc_id, source FROM documents WHERE {_SAMPLED}""",
    "sampled_split": f"""
        SELECT source, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS part, count(*) AS n
        FROM documents WHERE {_SAMPLED} GROUP BY ALL""",
    "spark_sample_strays": "SELECT cast(0 AS BIGINT) AS strays",
    "slice_union": f"""
        SELECT doc_id, lang, source FROM documents
        WHERE source = 'src0'
            OR {_bucket('doc_id', purpose='sample')} < cast({q.REST_FRACTION} AS DOUBLE)""",
    "split_parts": f"""
        SELECT doc_id, lang, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS part
        FROM documents""",
    "vocabulary": f"""
        WITH {_docs()}, {_vocabulary('doc_id', 0.2, 8000)}
        SELECT term, term_id, ctf, df, round(idf, 6) AS idf FROM vocab""",
    "tfidf_terms": f"""
        WITH {_docs()}, {_vocabulary('doc_id', 0.2, 8000)}
        SELECT doc_id, term, tf, round(tf * idf, 6) AS weight FROM counts JOIN vocab USING (term)""",
    "group_keywords_below": f"""
        WITH {_docs()}, {_vocabulary('source', 0.7, 3000)}
        SELECT source, term, tf, round(tf * idf, 6) AS weight
        FROM counts JOIN vocab USING (term) WHERE tf * idf < 3""",
    "group_keywords_top": f"""
        WITH {_docs()}, {_vocabulary('lang', 0.7, 3000)},
        ranked AS (
            SELECT lang, term, tf, tf * idf AS weight,
                   row_number() OVER (PARTITION BY lang ORDER BY tf * idf DESC, term) AS rank
            FROM counts JOIN vocab USING (term))
        SELECT lang, term, tf, round(weight, 6) AS weight, cast(rank AS INT) AS rank
        FROM ranked WHERE rank <= 20""",
    "keywords_by_slice": f"""
        WITH {_docs()},
        counts AS (
            SELECT lang, source, term, count(*) AS tf
            FROM (SELECT lang, source, unnest(tokens) AS term FROM docs) GROUP BY ALL),
        sizes AS (SELECT lang, count(DISTINCT source) AS n FROM docs GROUP BY lang),
        stats AS (
            SELECT lang, term, sum(tf) AS ctf, count(*) AS df FROM counts GROUP BY lang, term),
        vocab AS (
            SELECT lang, term, ln((n + 1.0) / (df + 1.0)) AS idf
            FROM stats JOIN sizes USING (lang) WHERE df <= cast(0.7 AS DOUBLE) * n
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY ctf DESC, term) <= 3000)
        SELECT lang, source, term, tf, round(tf * idf, 6) AS weight
        FROM counts JOIN vocab USING (lang, term) WHERE tf * idf < 3""",
    "token_bag": f"""
        SELECT role, turn, token, count(*) AS n
        FROM (SELECT role, turn, unnest({_tokens('text', 1)}) AS token FROM conversations)
        GROUP BY role, turn, token""",
    "collect_by": f"""
        WITH said AS (
            SELECT * FROM (
                SELECT conv_id, role, turn, {_tokens('text', 1)} AS tokens FROM conversations)
            WHERE len(tokens) >= 1),
        dealt AS (
            SELECT *, cast(floor(
                {_bucket('conv_id', purpose='chunk')} * {q.CHUNKS}) AS INT) AS chunk
            FROM said)
        SELECT role, turn, chunk, cast(sum(len(tokens)) AS BIGINT) AS n_tokens,
               md5(string_agg(array_to_string(tokens, ','), ',' ORDER BY conv_id)) AS tokens_md5
        FROM dealt GROUP BY role, turn, chunk""",
    "rule_tokens": f"""
        SELECT doc_id, len(tokens) AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5
        FROM (SELECT doc_id, regexp_extract_all(text, '{_quoted(q.TOKEN_RULES)}') AS tokens
              FROM documents)""",
    "collect_chunks": f"""
        WITH said AS (
            SELECT conv_id, role, turn, {_tokens('text', 1)} AS tokens FROM conversations),
        words AS (
            SELECT conv_id, role, turn, unnest(tokens) AS token,
                   generate_subscripts(tokens, 1) AS i FROM said),
        numbered AS (
            SELECT role, token,
                   row_number() OVER (PARTITION BY role ORDER BY conv_id, turn, i) - 1 AS n
            FROM words)
        SELECT role, cast(n // {q.CHUNK_TOKENS} AS BIGINT) AS chunk, count(*) AS n_tokens,
               md5(string_agg(token, ',' ORDER BY n)) AS tokens_md5
        FROM numbered GROUP BY role, n // {q.CHUNK_TOKENS}""",
    "sampled_tokens": f"""
        WITH {_DRAWN},
        said AS (
            SELECT *
            FROM (SELECT conv_id, copy, role, turn, {_tokens('text', 1)} AS tokens FROM drawn)
            WHERE len(tokens) >= 1)
        SELECT role, turn,
               md5(string_agg(array_to_string(tokens, ','), ',' ORDER BY conv_id, copy))
                   AS tokens_md5
        FROM said GROUP BY role, turn""",
    "max_pool": _pooled("max", "label"),
    "mean_pool": _pooled("avg", "label"),
    "max_pool_all": _pooled("max", ""),
    "nearest_k": _nearest(
        "vectors AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS v FROM embeddings)", "vec_id", 10
    ),
    "nearest_by_bounds": _nearest(
        "vectors AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS v FROM embeddings)", "vec_id", 10
    ),
    "most_similar_labels": _nearest(
        f"""{_LONG_VECTORS},
        pooled AS (SELECT label, i, max(value) AS value FROM values_of GROUP BY label, i),
        vectors AS (SELECT label, list(value ORDER BY i) AS v FROM pooled GROUP BY label)""",
        "label",
        3,
    ),
    "similarity_to_label": f"""
        WITH {_LONG_VECTORS},
        pooled AS (SELECT label, i, avg(value) AS m FROM values_of GROUP BY label, i)
        SELECT vec_id,
               round(sum(value * m) / (sqrt(sum(value * value)) * sqrt(sum(m * m))), 6) + 0.0
                   AS similarity
        FROM values_of JOIN pooled USING (label, i) GROUP BY vec_id""",
    "vector_cases": """
        WITH v AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS x FROM embeddings)
        SELECT vec_id, CASE vec_id % 4 WHEN 1 THEN cast(0 AS DOUBLE)
            WHEN 3 THEN round(list_cosine_similarity(x, list_reverse(x)), 6) + 0.0 END
            AS similarity
        FROM v""",
    "drift_by_entity": _drift(),
    "drift_chosen": _drift("WHERE label IN (1, 3, 5, 7)"),
    "drift_joined": _drift(),
    "drift_overall": _overall(),
    "drift_to_nowhere": _overall(q.NEVER),
    "embedding_means": f"""
        WITH {_docs()} SELECT count(*) AS n, cast(0 AS BIGINT) AS differing FROM docs""",
    "paragraph_languages": f"""
        WITH {_docs()} SELECT lang, count(*) AS n, true AS alike FROM docs GROUP BY lang""",
    "composition_counts": """
        SELECT quality, lang, source, count(quality) AS n
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality, lang, source""",
    "distinct_groups": "SELECT DISTINCT lang, source FROM documents",
    "silhouette": """
        WITH v AS (SELECT vec_id, label, cast(embedding AS DOUBLE[]) AS x FROM embeddings),
        sums AS (
            SELECT a.vec_id, a.label, b.label AS other, count(*) AS n,
                   sum(power(list_distance(a.x, b.x), 2)) AS s
            FROM v a CROSS JOIN v b GROUP BY a.vec_id, a.label, b.label),
        sides AS (
            SELECT vec_id, max(CASE WHEN other = label THEN n END) AS own_n,
                   max(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS own,
                   min(CASE WHEN other <> label THEN s / n END) AS near
            FROM sums GROUP BY vec_id)
        SELECT round(avg(CASE WHEN own_n = 1 THEN 0 ELSE (near - own) / greatest(near, own) END), 6)
            + 0.0 AS silhouette FROM sides""",
    "nb_predictions": _naive_bayes("lang", "documents") + """
        SELECT doc_id, label, prediction FROM predictions""",
    "nb_metrics": _naive_bayes("lang", "documents") + "," + _F1,
    "nb_quality_metrics": _naive_bayes(
        "quality", "(SELECT d.*, l.quality FROM documents d JOIN labels l USING (doc_id))"
    ) + "," + _F1,
    "svm_labels": f"""
        WITH {_docs()}
        SELECT lang AS label, count(*) AS n FROM docs WHERE NOT {_TRAIN} GROUP BY lang""",
    "sampled_classes": "SELECT *, n AS svm_n FROM (" + _naive_bayes(
        "lang",
        f"(SELECT * FROM documents WHERE {_SAMPLED} AND lang IN ({_list(q.CHAIN_LABELS)}))",
    ) + "," + _F1 + ")",
    "sampled_clusters": f"""
        WITH {_docs(source=f"(SELECT * FROM documents WHERE {_SAMPLED})")}
        SELECT source, lang, count(*) AS n FROM docs GROUP BY source, lang""",
    "topic_properties": f"""
        WITH {_docs()}, {_vocabulary('doc_id', 0.2, 8000)}
        SELECT cast(concept AS INT) AS concept, (SELECT count(*) FROM vocab) AS n_terms,
               cast(1 AS DOUBLE) AS norm, cast(0 AS DOUBLE) AS overlap,
               cast(0 AS DOUBLE) AS strength_error
        FROM range(1, 11) AS concepts(concept)""",
    "cluster_totals": f"""
        WITH {_docs()}
        SELECT source, lang, count(*) AS n FROM docs GROUP BY source, lang""",
    "silhouette_of_clusters": "SELECT cast(0 AS DOUBLE) AS difference",
    "label_metrics": """
        WITH predictions AS (SELECT toxic AS label, quality AS prediction FROM labels),""" + _F1,
    "confusion": """
        SELECT toxic AS label, quality AS prediction, count(*) AS n
        FROM labels GROUP BY toxic, quality""",
}
