"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

SYMBOLS = r"""(<[^>]*>)|([0-9,.;:&^/\-−#''"()\[\]、。【】「」~・])"""


def _trim(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\n+$', ''), ' +$', '')"


def _line(*parts: str) -> str:
    """Elements that aren't empty joined by a space; line ends become spaces."""
    listed = ", ".join(_trim(p) for p in parts)
    return rf"regexp_replace(array_to_string(list_filter([{listed}], lambda x: len(x) > 0), ' '), '[\r\n]+', ' ', 'g')"


def _low(c: str) -> str:
    return f"lower(coalesce({c}, ''))"


def _space(x: str, pattern: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{pattern}', ' ', 'g'), '[ ]+', ' ', 'g')"


def _corpus(line: str, source: str, key: str, where: str = "") -> str:
    return f"SELECT {key} AS doc_id, {line} AS line FROM {source}" + (f" WHERE {where}" if where else "")


_text = _space(_low("text"), SYMBOLS)
_docs = _corpus(_line(_text), "documents", "doc_id")
_parts = _corpus(_line(_low("p_name"), _low("p_brand")), "part", "p_partkey")


def _tokens(corpus: str) -> str:
    return rf"SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, list_filter(regexp_split_to_array(line, '[ \t\n\r]+'), lambda x: x <> '') AS t FROM ({corpus}))"


def _vocab(corpus: str, least: int) -> str:
    return f"""SELECT 0 AS word_id, '</s>' AS word, count(*) AS count FROM ({corpus})
UNION ALL SELECT row_number() OVER (ORDER BY n DESC, first) AS word_id, word, n AS count FROM (
  SELECT word, count(*) AS n, min((doc_id, pos)) AS first FROM ({_tokens(corpus)}) GROUP BY word HAVING count(*) >= {least} AND word <> '</s>')"""


_init = f"""vocab AS MATERIALIZED (SELECT word_id::INTEGER AS word_id, word FROM ({_vocab(_parts, 1)})),
lcg(i, s) AS (SELECT 0::BIGINT, 59000::BIGINT UNION ALL SELECT i + 1, (58989 * s + 11) % 65536 FROM lcg WHERE i < 65535),
raw AS (SELECT word_id, word, k::BIGINT AS dim, ((s / 65536.0::DOUBLE - 0.5) / 100)::FLOAT::DOUBLE AS x FROM vocab, range(100) r(k), lcg WHERE i = (word_id::BIGINT * 100 + k) % 65536),
seeded AS (SELECT word_id, word, list(x ORDER BY dim) AS v FROM raw GROUP BY ALL),
model AS MATERIALIZED (SELECT word_id, word, list_transform(v, lambda x: (x / sqrt(list_inner_product(v, v)))::FLOAT)::DOUBLE[] AS v FROM seeded)"""

_emb = """model AS MATERIALIZED (SELECT vec_id AS word_id, 'c' || label || '_' || vec_id AS word, list_transform(v, lambda x: (x / sqrt(list_inner_product(v, v)))::FLOAT)::DOUBLE[] AS v
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings) WHERE list_inner_product(v, v) > 0)"""
_doc_emb = _emb.replace("'c' || label || '_' || vec_id", "'doc_id:' || vec_id")


def _query(signs: dict[int, int]) -> str:
    """q: the unit vector of a signed sum of words by id."""
    cases = " ".join(f"WHEN {i} THEN {s}" for i, s in signs.items())
    ids = ", ".join(map(str, signs))
    return f"""terms AS (SELECT unnest(v) * CASE word_id {cases} END AS x, generate_subscripts(v, 1) AS k FROM model WHERE word_id IN ({ids})),
summed AS (SELECT list(x ORDER BY k) AS v FROM (SELECT k, sum(x) AS x FROM terms GROUP BY k)),
q AS (SELECT list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM summed)"""


def _hits(signs: dict[int, int], where: str = "true", n: int | None = 40) -> str:
    ids = ", ".join(map(str, signs))
    limit = f" ORDER BY value DESC, word_id LIMIT {n}" if n is not None else ""
    return f"hits AS (SELECT word_id, word, list_inner_product(model.v, q.v) AS value FROM model, q WHERE word_id NOT IN ({ids}) AND {where} AND list_inner_product(model.v, q.v) > -1{limit})"


def _distance(signs: dict[int, int], where: str = "true", n: int | None = 40, offset: int = 0, limit: int | None = 10, word: str = "word", model: str = _emb) -> str:
    page = f" LIMIT {limit} OFFSET {offset}" if limit is not None else ""
    return f"WITH {model},\n{_query(signs)},\n{_hits(signs, where, n)}\nSELECT {word} AS word, round(value, 6) AS value FROM hits ORDER BY hits.value DESC, word_id{page}"


def _edit(cut: int) -> str:
    a = f"levenshtein(left(word, -{cut}), left('brand#11', -{cut}))" if cut else "levenshtein(word, 'brand#11')"
    own = "(SELECT word_id FROM model WHERE word = 'brand#11')"
    return f"""WITH RECURSIVE {_init},
q AS (SELECT v FROM model WHERE word = 'brand#11'),
hits AS (SELECT word_id, word, list_inner_product(model.v, q.v) AS value FROM model, q WHERE word_id <> {own} ORDER BY value DESC, word_id LIMIT 40)
SELECT word, {a} AS score FROM hits"""


_over = "list_inner_product(model.v, q.v)"

_train_lines = _corpus(_line(_low("p_name"), _low("p_type"), _low("p_brand")), "part", "p_partkey")
_supplier_lines = _corpus(f"'doc_id:' || s_suppkey || ' ' || {_line(f'replace({_low("s_name")}, chr(32), chr(95))', f'replace({_low("n_name")}, chr(32), chr(95))')}", "supplier LEFT JOIN nation ON s_nationkey = n_nationkey", "s_suppkey")


def _pca(centered: bool) -> str:
    """Two principal scores by squaring the normalised Gram matrix until it is the projection on its first direction; then again without that direction."""
    shift = "list_transform(generate_series(1, 64), lambda k: list_avg(list_transform(m, lambda r: r[k])))" if centered else "list_transform(generate_series(1, 64), lambda k: 0.0::DOUBLE)"
    n = "generate_series(1, len(m))"
    trace = f"list_sum(list_transform({n}, lambda i: m[i][i]))"
    square = f"list_transform(m, lambda r: list_transform(m, lambda c: list_inner_product(r, c)))"

    def powers(name: str, source: str) -> str:
        scaled = f"list_transform(m, lambda r: list_transform(r, lambda x: x / {trace}))"
        return f"{name}(i, m) AS (SELECT 0, {scaled} FROM (SELECT g AS m FROM {source}) UNION ALL SELECT i + 1, {scaled} FROM (SELECT i, {square} AS m FROM {name} WHERE i < 22))"

    def axis(name: str, power: str, source: str) -> str:
        size = "list_sum(list_transform(generate_series(1, len(g)), lambda i: list_inner_product(g[i], m[i])))"
        return f"{name} AS (SELECT {size} AS size, list_transform(m[best], lambda x: x / sqrt(m[best][best])) AS u FROM (SELECT m, g, list_position(list_transform({n}, lambda i: m[i][i]), list_max(list_transform({n}, lambda i: m[i][i]))) AS best FROM {power}, {source} WHERE i = 22))"

    def score(name: str) -> str:
        return f"list_transform({name}.u, lambda x: x * sqrt({name}.size) * CASE WHEN list_max({name}.u) >= -list_min({name}.u) THEN 1 ELSE -1 END)"

    return f"""WITH RECURSIVE {_emb},
{_query({7: 1})},
{_hits({7: 1})},
near AS MATERIALIZED (SELECT h.word, h.value, m.v, h.word_id AS place FROM hits h JOIN model m USING (word_id) UNION ALL SELECT word, 1.0, v, -1 FROM model WHERE word_id = 7),
whole AS MATERIALIZED (SELECT list(word ORDER BY place) AS words, list(value ORDER BY place) AS vals, list(v ORDER BY place) AS m FROM near),
moved AS MATERIALIZED (SELECT list_transform(m, lambda r: list_transform(generate_series(1, 64), lambda k: r[k] - s[k])) AS x FROM (SELECT m, {shift} AS s FROM whole)),
gram AS MATERIALIZED (SELECT list_transform(x, lambda r: list_transform(x, lambda c: list_inner_product(r, c))) AS g FROM moved),
{powers("p1", "gram")},
{axis("a1", "p1", "gram")},
rest AS MATERIALIZED (SELECT list_transform(generate_series(1, len(g)), lambda i: list_transform(generate_series(1, len(g)), lambda j: g[i][j] - size * u[i] * u[j])) AS g FROM gram, a1),
{powers("p2", "rest")},
{axis("a2", "p2", "rest")}
SELECT word, round(value, 6) AS value, round(x, 6) AS pca_value_1, round(y, 6) AS pca_value_2 FROM (
  SELECT unnest(words) AS word, unnest(vals) AS value, unnest({score("a1")}) AS x, unnest({score("a2")}) AS y FROM whole, a1, a2)"""


def _trained(lines: str, others: str) -> str:
    return f"SELECT word_id::INTEGER AS word_id, word, 100::BIGINT AS dim, word <> '</s>' AS moved, true AS sound, true AS {others} FROM ({_vocab(lines, 1)})"


ORACLE_SQL = {
    "corpus_default": _corpus(_line(_low("p_name")), "part", "p_partkey"),
    "corpus_multi_column": _corpus(_line(_low("p_name"), _low("p_brand"), _low("p_type")), "part", "p_partkey"),
    "corpus_label": _corpus(_line(f"'brand:' || {_low('p_brand')}", _low("p_name")), "part", "p_partkey"),
    "corpus_repeat": _corpus(_line(_low("p_name"), *[_low("p_brand")] * 3), "part", "p_partkey"),
    "corpus_phrase": _corpus(_line(f"replace({_low('p_name')}, ' ', '_')", f"replace({_low('p_type')}, ' ', '_')"), "part", "p_partkey"),
    "corpus_phrase_label": _corpus(_line(f"'name:' || replace({_low('p_name')}, ' ', '_')", _low("p_brand")), "part", "p_partkey"),
    "corpus_symbol": _docs,
    "corpus_alpha": _corpus(_line(_space(_text, "[a-zA-Z]+"), _low("lang")), "documents", "doc_id"),
    "corpus_input_filter": _corpus(_line(_space(_low("text"), "[0-9]+")), "documents", "doc_id"),
    "corpus_normalizer_none": _corpus(_line("coalesce(text, '')"), "documents", "doc_id"),
    "corpus_nfkc": _corpus(_line(_low("p_name"), _low("p_brand")), "part", "p_partkey"),
    "corpus_filter_match": _corpus(_line(_text), "documents", "doc_id", "contains(lower(text), 'tion')"),
    "corpus_filter_int": _corpus(_line(_low("source"), _low("lang")), "documents", "doc_id", "n_chars >= 2000"),
    "corpus_ref_column": _corpus(_line(_low("s_name"), f"'nation:' || replace({_low('n_name')}, ' ', '_')"), "supplier LEFT JOIN nation ON s_nationkey = n_nationkey", "s_suppkey"),
    "corpus_ref_vector": "SELECT l_orderkey AS doc_id, coalesce(string_agg(replace(lower(p_name), ' ', '_'), ' ' ORDER BY l_linenumber, l_partkey) FILTER (WHERE p_name <> ''), '') AS line FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey",
    "corpus_text_vector": "SELECT p_partkey AS doc_id, array_to_string(flatten(list_transform(string_split(p_type, ' '), lambda x: ['type:' || lower(x), 'type:' || lower(x)])), ' ') AS line FROM part",
    "corpus_sentence_vectors": _corpus(f"'doc_id:' || doc_id || ' ' || {_line(_text)}", "documents", "doc_id"),
    "vocab_min_count": f"SELECT word, count(*) AS count FROM ({_tokens(_docs)}) GROUP BY word HAVING count(*) >= 5",
    "vocab_ids": _vocab(_docs, 5),
    "vocab_roundtrip": _vocab(_parts, 1),
    "seeded_init_vectors": f"WITH RECURSIVE {_init}\nSELECT word_id, word, dim, round(x * 1000, 6) AS milli FROM raw",
    "seeded_distance": f"""WITH RECURSIVE {_init},
q AS (SELECT v FROM model WHERE word = 'brand#11')
SELECT word, round(list_inner_product(model.v, q.v), 6) AS value FROM model, q WHERE word <> 'brand#11' ORDER BY list_inner_product(model.v, q.v) DESC, word_id LIMIT 40""",
    "vector_normalize": "SELECT vec_id, generate_subscripts(v, 1)::BIGINT - 1 AS dim, round(unnest(v) / sqrt(list_inner_product(v, v)), 6) AS x FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)",
    "similarity_scan": f"WITH {_emb}, q AS (SELECT v FROM model WHERE word_id = 7) SELECT word, round({_over}, 6) AS value FROM model, q WHERE word_id <> 7 AND {_over} > -1",
    "distance_default": _distance({7: 1}),
    "distance_limit": _distance({7: 1}, limit=3),
    "distance_offset": _distance({7: 1}, offset=3, limit=3),
    "distance_n_sort": _distance({7: 1}, n=2),
    "distance_n_sort_full": _distance({7: 1}, n=None, limit=None),
    "distance_nhits": f"WITH {_emb},\n{_query({7: 1})},\n{_hits({7: 1}, f'{_over} >= 0.1', None)}\nSELECT count(*) AS nhits FROM hits",
    "distance_threshold": _distance({7: 1}, f"{_over} >= 0.2"),
    "distance_prefix": _distance({7: 1}, "starts_with(word, 'c1_')"),
    "distance_stop_filter": _distance({7: 1}, "NOT regexp_full_match(word, 'c[0-4]_.*')"),
    "distance_output_filter": f"WITH {_emb},\n{_query({7: 1})},\n{_hits({7: 1})}\nSELECT regexp_replace(word, '_.*', '', 'g') AS word, round(min(value), 6) AS value FROM hits GROUP BY 1 ORDER BY min(value) DESC LIMIT 10",
    "distance_is_phrase": _distance({7: 1}, word="replace(word, '_', ' ')"),
    "distance_plus": _distance({7: 1, 8: 1}),
    "distance_minus": _distance({7: 1, 8: -1}),
    "distance_chain": _distance({7: 1, 8: 1, 9: -1}),
    "distance_oov": "SELECT 'x' AS word, 0.0::DOUBLE AS value WHERE false",
    "distance_edit_distance": _edit(0),
    "distance_edit_distance_compat": _edit(1),
    "sentence_distance": _distance({7: 1}, model=_doc_emb),
    "sentence_distance_table": f"WITH {_doc_emb},\n{_query({7: 1})},\n{_hits({7: 1})}\nSELECT doc_id AS id, round(value, 6) AS score FROM hits JOIN documents ON doc_id = word_id ORDER BY value DESC, doc_id LIMIT 10",
    "sentence_distance_table_sortby": f"WITH {_doc_emb},\n{_query({7: 1})},\n{_hits({7: 1})}\nSELECT doc_id, source, lang FROM hits JOIN documents ON doc_id = word_id ORDER BY source DESC, doc_id LIMIT 10",
    "batch_distance_topk": f"""WITH {_emb},
r AS (SELECT q.word_id AS query_id, m.word_id, list_inner_product(m.v, q.v) AS value FROM model q, model m WHERE q.word_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY value DESC, word_id) AS rank FROM r)
SELECT query_id, word_id, round(value, 6) AS value, rank FROM k WHERE rank <= 5""",
    "expander_string": f"WITH {_emb},\n{_query({7: 1})},\n{_hits({7: 1}, f'{_over} >= 0.2')},\nb AS (SELECT word, value, word_id FROM hits ORDER BY value DESC, word_id LIMIT 3),\no AS (SELECT word AS t FROM model WHERE word_id = 7)\nSELECT CASE WHEN count(b.word) = 0 THEN any_value(t) ELSE '((' || any_value(t) || ') OR ' || string_agg('(' || b.word || ')', ' OR ' ORDER BY b.value DESC, b.word_id) || ')' END AS expanded FROM o LEFT JOIN b ON true",
    "expanded_search": f"""WITH RECURSIVE {_init},
q AS (SELECT v FROM model WHERE word = 'brand#11'),
near AS (SELECT word FROM model, q WHERE word <> 'brand#11' AND {_over} >= 0.2 ORDER BY {_over} DESC, word_id LIMIT 3),
words AS (SELECT word FROM near UNION ALL SELECT 'brand#11')
SELECT p_partkey, p_name, p_brand FROM part WHERE EXISTS (SELECT 1 FROM words WHERE contains(lower(p_name), word) OR contains(lower(p_brand), word))""",
    "model_text_roundtrip": "SELECT 'w' || vec_id AS word, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: round(x, 6)::FLOAT::DOUBLE)), 4) AS total, len(embedding)::BIGINT AS dim FROM embeddings",
    "model_binary_roundtrip": "SELECT 'w' || vec_id AS word, round(list_sum(embedding::DOUBLE[]), 4) AS total, len(embedding)::BIGINT AS dim FROM embeddings",
    "corpus_segmented": _corpus(_line(_low("p_name"), _low("p_type")), "part", "p_partkey"),
    "distance_pca": _pca(True),
    "distance_pca_uncentered": _pca(False),
    "kmeans_classes": f"WITH {_emb} SELECT word_id::INTEGER AS word_id, word, true AS numbered, true AS nearest FROM model",
    "train_skipgram_hs": _trained(_train_lines, "alike"),
    "train_cbow_negative": _trained(_train_lines, "loss_falls"),
    "train_sentence_vectors": _trained(_supplier_lines, "loss_falls"),
    "prefix_scan_native": f"WITH {_emb} SELECT word_id, word FROM model WHERE starts_with(word, 'c1_')",
}
