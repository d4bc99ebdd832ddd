"""Independent SQL for each query, written for DuckDB over the same Parquet tables."""

from __future__ import annotations

import math

from ratewell.schemas import BLEND_WEIGHTS, KEY_PREFIXES, RIDGE_ALPHAS

REVIEWS = """reviews AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
    CASE WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN NULL ELSE o_custkey::VARCHAR END AS user_id,
    concat_ws('-', l_partkey, l_suppkey) AS prod_id,
    l_partkey::VARCHAR AS parent_prod_id,
    epoch(l_shipdate)::BIGINT AS time,
    (NULLIF(l_linenumber, 1) - 3)::INTEGER AS votes,
    CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS purchased,
    CASE WHEN l_quantity <= 4 THEN 1 WHEN l_quantity <= 6 THEN 2 WHEN l_quantity <= 10 THEN 3
         WHEN l_quantity <= 20 THEN 4 ELSE 5 END AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"
SPLIT = f"""{REVIEWS},
split AS (SELECT *, CASE WHEN {HASH.format("'42:' || id")} % 100 < 80 THEN 'train' ELSE 'val' END AS split
  FROM reviews),
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train'),
val AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'val')"""

TEXTS = """parts AS (SELECT doc_id AS id, text, instr(text, chr(10)) AS cut FROM documents),
texts AS (SELECT id, NULLIF(CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) ELSE text END, '') AS title,
    NULLIF(CASE WHEN cut > 0 THEN substr(text, cut + 1) END, '') AS comment FROM parts),
joined AS (SELECT id, coalesce(title, '') || ' [SEP] ' || coalesce(comment, '') AS text FROM texts)"""

WORDS = TEXTS + r""",
words AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS words
  FROM joined)"""

FLAG = "coalesce(purchased::INTEGER::DOUBLE, 0.0)"
VOTES = "coalesce(votes, 0)::DOUBLE"
VOTES_LOG = "ln(1 + greatest(coalesce(votes, 0), 0)::DOUBLE)"


def _count(key: str) -> str:
    return f"CASE WHEN {key} IS NULL THEN 0 ELSE count(rating) OVER (PARTITION BY {key}) END"


def _loo_avg(key: str, rows: str) -> str:
    return f"""CASE WHEN {key} IS NOT NULL AND count(rating) OVER (PARTITION BY {key}) > 1
      THEN (sum(rating) OVER (PARTITION BY {key}) - rating)::DOUBLE / (count(rating) OVER (PARTITION BY {key}) - 1)
      ELSE (SELECT avg(rating) FROM {rows}) END"""


def _loo(rows: str, name: str = "encoded", keys: dict[str, str] = KEY_PREFIXES) -> str:
    """CTE ``name``: ``rows`` with the leave-one-out mean, count and log count of each key."""
    columns = ", ".join(
        f"{_loo_avg(k, rows)} AS {p}_loo_avg, {_count(k)} AS {p}_cnt, ln(1 + ({_count(k)})::DOUBLE) AS {p}_log_cnt"
        for k, p in keys.items()
    )
    return f"{name} AS (SELECT *, {columns} FROM {rows})"


def _lookup(
    name: str = "looked_up",
    keys: dict[str, str] = KEY_PREFIXES,
    count: str = "count(*)",
    known: str = "train",
    rows: str = "val",
) -> str:
    """CTE ``name``: ``rows`` with the statistics that ``known`` has for each key."""
    tables = ", ".join(
        f"{known}_{p} AS (SELECT {k}, avg(rating) AS a, {count} AS n FROM {known} WHERE {k} IS NOT NULL GROUP BY 1)"
        for k, p in keys.items()
    )
    columns = ", ".join(
        f"coalesce({known}_{p}.a, (SELECT avg(rating) FROM {known})) AS {p}_avg, coalesce({known}_{p}.n, 0) AS {p}_cnt, "
        f"ln(1 + coalesce({known}_{p}.n, 0)::DOUBLE) AS {p}_log_cnt"
        for p in keys.values()
    )
    joins = " ".join(f"LEFT JOIN {known}_{p} ON {rows}.{k} = {known}_{p}.{k}" for k, p in keys.items())
    return f"{tables}, {name} AS (SELECT {rows}.*, {columns} FROM {rows} {joins})"


STATS = [f"{p}_{c}" for p in KEY_PREFIXES.values() for c in ("avg", "log_cnt")]
NUMERIC = ["purchased", "votes", *STATS]


def _numeric(rows: str, average: str, votes: str = VOTES, extra: str = "") -> str:
    columns = ", ".join(f"{p}_{average} AS {p}_avg, {p}_log_cnt" for p in KEY_PREFIXES.values())
    return f"SELECT id, {FLAG} AS purchased, {votes} AS votes, {columns}{extra} FROM {rows}"


def _round(names: list[str], digits: int) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)


def _loo_query(key: str, prefix: str) -> str:
    return f"""WITH {REVIEWS}, {_loo('reviews', keys={key: prefix})}
SELECT id, {prefix}_loo_avg, {prefix}_cnt, round({prefix}_log_cnt, 9) + 0.0 AS {prefix}_log_cnt FROM encoded"""


def _group_stats(key: str) -> str:
    return f"""SELECT {key}, sum(rating)::BIGINT AS rating_sum, count(rating) AS rating_count,
  avg(rating) AS rating_mean FROM reviews GROUP BY 1"""


def _group_mean_encode(key: str) -> str:
    return f"""WITH {REVIEWS}
SELECT {key}, CASE WHEN count(rating) > 1 THEN avg(rating) ELSE (SELECT avg(rating) FROM reviews) END AS {key}_avg,
  count(rating) AS {key}_count, round(ln(1 + count(rating)::DOUBLE), 9) + 0.0 AS {key}_log_count
FROM reviews GROUP BY {key}"""


LOO_FEATURES = f"""WITH {REVIEWS}, {_loo('reviews')}, features AS ({_numeric('encoded', 'loo_avg')})
SELECT id, purchased, votes, user_avg, prod_avg, parent_avg,
  {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM features"""

SPLIT_FEATURES = f"""{SPLIT}, {_loo('train')}, {_lookup()},
features AS ({_numeric('encoded', 'loo_avg', extra=", 'train' AS split")}
  UNION ALL {_numeric('looked_up', 'avg', extra=", 'val' AS split")})"""

PAIRS = f"""{REVIEWS}, {_loo('reviews', keys={'user_id': 'user', 'parent_prod_id': 'parent'})},
pairs AS (SELECT id, rating, greatest(1.0, least(5.0, user_loo_avg))::DOUBLE AS rating_a,
  greatest(1.0, least(5.0, parent_loo_avg))::DOUBLE AS rating_b FROM encoded),
blended AS (SELECT id, greatest(1.0::DOUBLE, least(5.0::DOUBLE,
  0.7::DOUBLE * rating_a + (1.0::DOUBLE - 0.7::DOUBLE) * rating_b)) AS rating FROM pairs)"""


def _raw_moments(rows: str, name: str) -> str:
    """CTE ``name``: centred sums of the two raw columns and the rating."""
    return f"""{name} AS (SELECT count(*) AS n, avg(p) AS mp, avg(v) AS mv, avg(y) AS my,
  sum(p * p) - count(*) * avg(p) * avg(p) AS spp, sum(v * v) - count(*) * avg(v) * avg(v) AS svv,
  sum(p * v) - count(*) * avg(p) * avg(v) AS spv, sum(p * y) - count(*) * avg(p) * avg(y) AS spy,
  sum(v * y) - count(*) * avg(v) * avg(y) AS svy FROM {rows})"""


def _ridge(moments: str, alphas: str, name: str) -> str:
    """CTE ``name``: the two-feature ridge solution per penalty by Cramer's rule."""
    return f"""{name}_w AS (SELECT alpha, mp, mv, my,
    ((svv + alpha) * spy - spv * svy) / ((spp + alpha) * (svv + alpha) - spv * spv) AS wp,
    ((spp + alpha) * svy - spv * spy) / ((spp + alpha) * (svv + alpha) - spv * spv) AS wv
  FROM {moments} CROSS JOIN {alphas}),
{name} AS (SELECT alpha, wp, wv, my - wp * mp - wv * mv AS b FROM {name}_w)"""


RAW = f"""{SPLIT}, raw AS (SELECT id, split, {FLAG} AS p, {VOTES} AS v, rating::DOUBLE AS y FROM split),
raw_train AS (SELECT * FROM raw WHERE split = 'train'), raw_val AS (SELECT * FROM raw WHERE split = 'val'),
alphas AS (SELECT unnest([{', '.join(f'{a}::DOUBLE' for a in RIDGE_ALPHAS)}]) AS alpha)"""

GRID = f"""{RAW}, {_raw_moments('raw_train', 'm')}, {_ridge('m', 'alphas', 'models')},
grid AS (SELECT alpha, sqrt(avg(pow(greatest(1.0::DOUBLE, least(5.0::DOUBLE, b + wp * p + wv * v)) - y, 2))) AS rmse
  FROM raw_val CROSS JOIN models GROUP BY alpha)"""

#: Leave-one-out residuals of two features: each residual over one less its leverage.
LEAVE_ONE_OUT = f"""WITH {RAW}, {_raw_moments('raw', 'm')}, {_ridge('m', 'alphas', 'models')},
alone AS (SELECT alpha, y, y - (y - b - wp * p - wv * v) / (1 - 1.0::DOUBLE / n
    - ((svv + alpha) * (p - mp) * (p - mp) - 2 * spv * (p - mp) * (v - mv) + (spp + alpha) * (v - mv) * (v - mv))
      / ((spp + alpha) * (svv + alpha) - spv * spv)) AS guess
  FROM raw CROSS JOIN m CROSS JOIN models)
SELECT alpha, round(sqrt(avg(pow(greatest(1.0::DOUBLE, least(5.0::DOUBLE, guess)) - y, 2))), 9) AS rmse
FROM alone GROUP BY alpha"""

#: The reviews after the load of corrections.
CORRECTED = f"{REVIEWS}, corrected AS (SELECT * REPLACE (CASE WHEN rating = 3 THEN 2 ELSE rating END AS rating) FROM reviews)"

RIDGE_FIT = f"""WITH {RAW}, one AS (SELECT 1.0::DOUBLE AS alpha), {_raw_moments('raw', 'm')}, {_ridge('m', 'one', 'model')}
SELECT u.pos::INTEGER AS pos, round(u.value, 6) + 0.0 AS value
FROM (SELECT unnest([{{'pos': 0, 'value': b}}, {{'pos': 1, 'value': wp}}, {{'pos': 2, 'value': wv}}]) AS u FROM model)"""

EMBEDDED = f"""z AS (SELECT vec_id, CASE WHEN {HASH.format("'42:' || vec_id::VARCHAR")} % 100 < 80 THEN 'train' ELSE 'val' END AS split,
  embedding::DOUBLE[] AS x, label::DOUBLE AS y, len(embedding) AS d FROM embeddings)"""


def _eliminated(rows: str, specs: str, name: str) -> str:
    """CTEs: the ridge solution of each of ``specs (features, alpha, places)`` on ``rows (vec_id, x, y)``,
    from the centred normal equations of the features at ``places``, by Gauss-Jordan elimination with
    one feature per recursion step. The result is ``(features, alpha, places, w, b)`` with lists."""
    target = f"(SELECT max(i) FROM {name}_mean)"
    return f"""{name}_flat AS (SELECT vec_id, unnest(range(1, len(x) + 2)) AS i, unnest(list_append(x, y)) AS v FROM {rows}),
{name}_mean AS (SELECT i, avg(v) AS m FROM {name}_flat GROUP BY i),
{name}_centred AS (SELECT vec_id, i, v - m AS v FROM {name}_flat JOIN {name}_mean USING (i)),
{name}_gram AS (SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS v FROM {name}_centred a JOIN {name}_centred b USING (vec_id)
  GROUP BY 1, 2),
{name}_rows AS (SELECT features, alpha, i, list(v + CASE WHEN i = j THEN alpha ELSE 0 END ORDER BY j) AS r
  FROM {name}_gram CROSS JOIN {specs}
  WHERE list_contains(places, i) AND (list_contains(places, j) OR j = {target}) GROUP BY features, alpha, i),
{name}_steps AS (
  SELECT features, alpha, 1 AS k, list(r ORDER BY i) AS m FROM {name}_rows GROUP BY features, alpha
  UNION ALL
  SELECT features, alpha, k + 1, list_transform(range(1, len(m) + 1), lambda i: CASE WHEN i = k
      THEN list_transform(m[k], lambda v: v / m[k][k])
      ELSE list_transform(range(1, len(m) + 2), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END)
  FROM {name}_steps WHERE k <= len(m)),
{name}_w AS (SELECT features, alpha, list_transform(m, lambda r: r[len(m) + 1]) AS w
  FROM {name}_steps WHERE k = len(m) + 1),
{name} AS (SELECT features, alpha, places, w, (SELECT m FROM {name}_mean WHERE i = {target})
  - list_sum(list_transform(range(1, len(w) + 1), lambda i: w[i] * means[places[i]])) AS b
  FROM {name}_w JOIN {specs} USING (features, alpha)
  CROSS JOIN (SELECT list(m ORDER BY i) AS means FROM {name}_mean))"""


def _specs(subsets: dict[str, str], alphas: tuple[float, ...] = RIDGE_ALPHAS) -> str:
    """CTE ``specs``: every named list of feature places with every penalty."""
    places = " UNION ALL ".join(f"SELECT '{name}' AS features, {places} AS places" for name, places in subsets.items())
    values = ", ".join(f"{a}::DOUBLE" for a in alphas)
    return f"specs AS (SELECT features, alpha, places FROM ({places}) CROSS JOIN (SELECT unnest([{values}]) AS alpha))"


VAL_RMSE = """round(sqrt(avg(pow(greatest(1.0::DOUBLE, least(5.0::DOUBLE,
  b + list_inner_product(list_transform(places, lambda p: x[p]), w))) - y, 2))), 6) AS rmse"""

BASELINES = f"""{REVIEWS}, {_loo('reviews')}, predictors AS (
  SELECT 'prior' AS predictor, (SELECT avg(rating) FROM reviews) AS p, rating AS y FROM encoded
  {' '.join(f"UNION ALL SELECT '{p}', {p}_loo_avg, rating FROM encoded" for p in KEY_PREFIXES.values())}),
baselines AS (SELECT predictor, sqrt(avg(pow(greatest(1.0, least(5.0, p)) - y, 2))) AS rmse
  FROM predictors GROUP BY predictor)"""


def _hashed(source: str) -> str:
    """CTEs: per id of ``source (id, words)`` the 32 elements of the hashed mean embedding."""
    return f"""slots AS (SELECT id, {HASH.format('word')} AS h, len(words) AS n
  FROM (SELECT id, words, unnest(words) AS word FROM {source})),
sums AS (SELECT id, h % 32 AS pos, sum(CASE WHEN (h // 32) % 2 = 0 THEN 1 ELSE -1 END) / any_value(n)::DOUBLE AS value
  FROM slots GROUP BY 1, 2),
grid AS (SELECT id, unnest(range(32)) AS pos FROM {source}),
hashed AS (SELECT grid.id, grid.pos, coalesce(value, 0.0)::FLOAT::DOUBLE AS value
  FROM grid LEFT JOIN sums ON grid.id = sums.id AND grid.pos = sums.pos)"""


VOCABULARY = """vocab AS (SELECT token, token_count, row_number() OVER (ORDER BY token_count DESC, md5(token), token) + 1 AS token_id
  FROM (SELECT token, count(*) AS token_count FROM (SELECT unnest(words) AS token FROM words) GROUP BY 1)
  WHERE token_count >= {})"""

UNBOUNDED = ["user_log_cnt", "prod_log_cnt", "parent_log_cnt", "purchased", "votes"]


def _moments(columns: list[str], rows: str) -> str:
    """CTE ``moments``: one row, the mean and deviation of each column, computed once."""
    parts = ", ".join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in columns)
    return f"moments AS MATERIALIZED (SELECT {parts} FROM {rows})"


def _scaled(columns: list[str], epsilon: str = "") -> str:
    return ", ".join(f"round(({c} - {c}_mean) / ({c}_std{epsilon}), 6) + 0.0 AS {c}" for c in columns)


def _narrowed(rows: str, name: str) -> str:
    """CTE ``name``: the columns of ``rows`` that features are made of."""
    return f"{name} AS MATERIALIZED (SELECT id, {', '.join(KEY_PREFIXES)}, purchased, votes, rating FROM {rows})"


def _totals(rows: str) -> str:
    """CTEs: sum and number of ratings of ``rows`` per key, and the mean of all."""
    tables = ", ".join(
        f"{p}_t AS MATERIALIZED (SELECT {k}, sum(rating)::BIGINT AS s, count(rating) AS n FROM {rows} WHERE {k} IS NOT NULL GROUP BY 1)"
        for k, p in KEY_PREFIXES.items()
    )
    return f"{tables}, all_t AS MATERIALIZED (SELECT avg(rating) AS g FROM {rows})"


def _others(rows: str, known: str, votes: str = VOTES, extra: str = "") -> str:
    """The numeric features of ``rows`` by grouped tables: without the row's own rating if the rows are the known ones."""
    own = rows == known
    columns = ", ".join(
        (
            f"CASE WHEN {p}_t.n > 1 THEN ({p}_t.s - rating)::DOUBLE / ({p}_t.n - 1) ELSE g END AS {p}_avg"
            if own
            else f"CASE WHEN {p}_t.n > 0 THEN {p}_t.s::DOUBLE / {p}_t.n ELSE g END AS {p}_avg"
        )
        + f", ln(1 + coalesce({p}_t.n, 0)::DOUBLE) AS {p}_log_cnt"
        for p in KEY_PREFIXES.values()
    )
    joins = " ".join(f"LEFT JOIN {p}_t ON {rows}.{k} = {p}_t.{k}" for k, p in KEY_PREFIXES.items())
    return f"SELECT id, {FLAG} AS purchased, {votes} AS votes, {columns}{extra} FROM {rows} {joins}, all_t"


SPLIT_TABLES = f"""{SPLIT}, {_narrowed('train', 'slim')}, {_narrowed('val', 'slim_val')}, {_totals('slim')},
features AS MATERIALIZED ({_others('slim', 'slim', extra=", 'train' AS split, rating")}
  UNION ALL {_others('slim_val', 'slim', extra=", 'val' AS split, rating")})"""


def _forest(trees: int, depth: int, bins: int, cells: int) -> str:
    """CTEs of boosted trees on ``features``: bins from counts of cells, then per level the sums, the best cut of
    each node and the next nodes; ``fitted_N`` has the sum of the first N trees, ``cuts_N_L`` and ``leaves_N``
    the trees."""
    names = ", ".join(f"'{c}'" for c in NUMERIC)
    values = ", ".join(f"round({c}, 9)" if c.endswith("log_cnt") else c for c in NUMERIC)
    out = f"""flat AS MATERIALIZED (SELECT id, split, rating, unnest(range({len(NUMERIC)})) AS f, unnest([{names}]) AS name,
  unnest([{values}]::DOUBLE[]) AS x FROM features),
ranges AS MATERIALIZED (SELECT f, min(x) AS low, max(x) AS high FROM flat WHERE split = 'train' GROUP BY 1),
celled AS MATERIALIZED (SELECT id, split, rating, f, name, CASE WHEN high > low
  THEN greatest(0, least({cells - 1}, floor((x - low) / (high - low) * {cells})))::INTEGER ELSE 0 END AS cell
  FROM flat JOIN ranges USING (f)),
shares AS (SELECT f, cell, ((sum(n) OVER (PARTITION BY f ORDER BY cell) - n) * {bins}) // sum(n) OVER (PARTITION BY f) AS share
  FROM (SELECT f, cell, count(*) AS n FROM celled WHERE split = 'train' GROUP BY 1, 2)),
starts AS MATERIALIZED (SELECT f, min(cell) AS start FROM shares WHERE share > 0 GROUP BY f, share),
start_lists AS MATERIALIZED (SELECT f, list(start) AS starts FROM starts GROUP BY 1),
bins AS MATERIALIZED (SELECT id, split, (rating::DOUBLE * 1000000)::BIGINT AS y, f, name,
  coalesce(len(list_filter(starts, lambda t: t <= cell)), 0) AS bin FROM celled LEFT JOIN start_lists USING (f)),
fitted_0 AS MATERIALIZED (SELECT id, split, y, (SELECT floor(sum(y)::DOUBLE / count(*) + 0.5)::BIGINT FROM bins
  WHERE split = 'train' AND f = 0) AS p FROM bins WHERE f = 0)"""
    for t in range(1, trees + 1):
        out += f",\nnode_{t}_0 AS MATERIALIZED (SELECT id, split, y - p AS g, 0 AS node FROM fitted_{t - 1})"
        for level in range(depth):
            at = f"{t}_{level}"
            out += f""",
sums_{at} AS (SELECT node, f, name, bin, count(*) AS n, sum(g)::BIGINT AS g FROM node_{at} JOIN bins USING (id)
  WHERE node_{at}.split = 'train' GROUP BY ALL),
sides_{at} AS (SELECT *, sum(n) OVER up AS ln, sum(g) OVER up AS lg, sum(n) OVER whole AS an, sum(g) OVER whole AS ag
  FROM sums_{at} WINDOW up AS (PARTITION BY node, f ORDER BY bin), whole AS (PARTITION BY node, f)),
gains_{at} AS (SELECT *, pow(lg::DOUBLE, 2) / ln + pow((ag - lg)::DOUBLE, 2) / (an - ln) - pow(ag::DOUBLE, 2) / an AS gain
  FROM sides_{at} WHERE an > ln),
cuts_{at} AS MATERIALIZED (SELECT node, f, name, bin AS cut FROM gains_{at} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1),
node_{t}_{level + 1} AS MATERIALIZED (SELECT m.id, m.split, m.g, m.node * 2 + coalesce(b.bin > c.cut, false)::INTEGER AS node
  FROM node_{at} m LEFT JOIN cuts_{at} c USING (node) LEFT JOIN bins b ON b.id = m.id AND b.f = c.f)"""
        out += f""",
leaves_{t} AS MATERIALIZED (SELECT node, floor(0.3::DOUBLE * sum(g) / count(*) + 0.5)::BIGINT AS leaf FROM node_{t}_{depth}
  WHERE split = 'train' GROUP BY 1),
fitted_{t} AS MATERIALIZED (SELECT id, d.split, y, p + coalesce(leaf, 0) AS p FROM fitted_{t - 1} d JOIN node_{t}_{depth} n USING (id)
  LEFT JOIN leaves_{t} USING (node))"""
    return out


def _forest_nodes(trees: int, depth: int) -> str:
    parts = []
    for t in range(1, trees + 1):
        for level in range(depth):
            parts.append(
                f"SELECT {t} AS tree, ({1 << level} + i)::INTEGER AS node, name AS feature, cut::INTEGER AS cut, NULL::DOUBLE AS value "
                f"FROM range({1 << level}) r(i) LEFT JOIN cuts_{t}_{level} ON node = i"
            )
        parts.append(
            f"SELECT {t}, ({1 << depth} + i)::INTEGER, NULL, NULL, coalesce(leaf, 0) / 1000000.0::DOUBLE "
            f"FROM range({1 << depth}) r(i) LEFT JOIN leaves_{t} ON node = i"
        )
    return " UNION ALL ".join(parts)


PAIR_COUNTS = f"""{WORDS}, gaps AS (SELECT words, unnest([1, 2]) AS gap FROM words),
ahead AS (SELECT unnest(words[1:len(words) - gap]) AS a, unnest(words[gap + 1:len(words)]) AS b FROM gaps WHERE len(words) > gap),
often AS (SELECT token FROM (SELECT unnest(words) AS token FROM words) GROUP BY 1 HAVING count(*) >= 2),
pairs AS MATERIALIZED (SELECT word, other, count(*) AS n FROM (SELECT a AS word, b AS other FROM ahead UNION ALL SELECT b, a FROM ahead)
  WHERE word IN (SELECT token FROM often) AND other IN (SELECT token FROM often) GROUP BY 1, 2),
word_totals AS (SELECT word, sum(n) AS total FROM pairs GROUP BY 1),
information AS MATERIALIZED (SELECT p.word, p.other, n, ln(n::DOUBLE * (SELECT sum(n)::DOUBLE FROM pairs) / a.total / b.total) AS weight
  FROM pairs p JOIN word_totals a ON p.word = a.word JOIN word_totals b ON p.other = b.word)"""

STATS_FIRST = [*STATS, "purchased", "votes"]
SUBSETS = {
    "embedding": ([], 32),
    "embedding_raw": (["purchased", "votes"], 32),
    "embedding_all": (NUMERIC, 32),
    "raw": (["purchased", "votes"], 0),
    "stats": (STATS, 0),
    "stats_raw": (NUMERIC, 0),
}
SUBSET_COLUMNS = ", ".join(
    f"round({' + '.join([*columns, *(['e.total'] if width else [])])}, 5) + 0.0 AS {name}_sum, "
    f"{len(columns) + width}::BIGINT AS {name}_width"
    for name, (columns, width) in SUBSETS.items()
)

PRODUCT_EMBEDDINGS = f"""word_lists AS (SELECT p_partkey::VARCHAR AS id,
  string_split(lower(p_name || ' [SEP] ' || p_brand || ' ' || p_type), ' ') AS words FROM part),
{_hashed('word_lists')},
e AS (SELECT id AS parent_prod_id, sum(value) AS total, list(value ORDER BY pos) AS embedding FROM hashed GROUP BY 1)"""

SCALED_LIST = ", ".join(
    f"({c} - (SELECT avg({c}) FROM features WHERE split = 'train')) / "
    f"((SELECT stddev_pop({c}) FROM features WHERE split = 'train') + 1e-8)"
    for c in NUMERIC
)
# Places 1 to 32 are the embedding, then the numeric columns in their order.
SUBSET_PLACES = {
    name: "list_concat(range(1, {}), [{}]::BIGINT[])".format(
        width + 1, ", ".join(str(33 + NUMERIC.index(c)) for c in columns)
    )
    for name, (columns, width) in SUBSETS.items()
}
def _stump(rows: str) -> str:
    """CTEs: ``stump``, the validation error of the best split of ``rows (p, v, y, split)`` in two leaves."""
    return f"""sides AS (SELECT y, split, unnest([0, 1]) AS f, unnest([p, v]) AS x FROM {rows}),
cuts AS (SELECT DISTINCT f, x AS t FROM sides WHERE split = 'train'),
gains AS (SELECT f, t, avg(y) FILTER (x <= t) AS low, avg(y) FILTER (x > t) AS high,
    pow(sum(y) FILTER (x <= t), 2) / count(*) FILTER (x <= t) + pow(sum(y) FILTER (x > t), 2) / count(*) FILTER (x > t) AS gain
  FROM (SELECT * FROM sides WHERE split = 'train') JOIN cuts USING (f) GROUP BY f, t HAVING count(*) FILTER (x > t) > 0),
chosen AS (SELECT * FROM gains ORDER BY gain DESC, f, t LIMIT 1),
stump AS (SELECT round(sqrt(avg(pow(greatest(1.0::DOUBLE, least(5.0::DOUBLE,
    CASE WHEN x <= t THEN low ELSE high END)) - y, 2))), 6) AS rmse FROM sides JOIN chosen USING (f) WHERE split = 'val')"""


ABLATION = f"""WITH RECURSIVE {SPLIT}, {_loo('train')}, {_lookup()},
features AS ({_numeric('encoded', 'loo_avg', extra=", parent_prod_id, rating, 'train' AS split")}
  UNION ALL {_numeric('looked_up', 'avg', extra=", parent_prod_id, rating, 'val' AS split")}),
{PRODUCT_EMBEDDINGS},
z AS (SELECT id AS vec_id, split, list_concat(embedding, [{SCALED_LIST}]) AS x, rating::DOUBLE AS y
  FROM features JOIN e USING (parent_prod_id)),
fitted AS (SELECT * FROM z WHERE split = 'train'),
{_specs(SUBSET_PLACES)}, {_eliminated('fitted', 'specs', 'models')},
shallow AS (SELECT split, purchased AS p, votes AS v, rating::DOUBLE AS y FROM features), {_stump('shallow')}
SELECT 'ridge' AS model, features, alpha, {VAL_RMSE}
FROM z CROSS JOIN models WHERE split = 'val' GROUP BY features, alpha
UNION ALL SELECT 'gbt', 'raw', NULL::DOUBLE, rmse FROM stump"""

# The test rows are a split by another seed; the others are split again into train and val.
SUBMISSION = f"""WITH RECURSIVE {REVIEWS},
parted AS (SELECT *, {HASH.format("'7:' || id")} % 100 < 80 AS is_known FROM reviews),
known AS (SELECT * EXCLUDE (is_known), CASE WHEN {HASH.format("'42:' || id")} % 100 < 80 THEN 'train' ELSE 'val' END AS split
  FROM parted WHERE is_known),
test AS (SELECT * EXCLUDE (is_known) FROM parted WHERE NOT is_known),
train AS (SELECT * EXCLUDE (split) FROM known WHERE split = 'train'),
val AS (SELECT * EXCLUDE (split) FROM known WHERE split = 'val'),
{_loo('train')}, {_lookup()}, {_lookup('test_looked_up', known='known', rows='test')},
features AS ({_numeric('encoded', 'loo_avg', extra=", parent_prod_id, rating, 'train' AS split")}
  UNION ALL {_numeric('looked_up', 'avg', extra=", parent_prod_id, rating, 'val' AS split")}
  UNION ALL {_numeric('test_looked_up', 'avg', extra=", parent_prod_id, rating, 'test' AS split")}),
{PRODUCT_EMBEDDINGS},
z AS (SELECT id AS vec_id, split, list_concat(embedding, [{SCALED_LIST}]) AS x, rating::DOUBLE AS y
  FROM features JOIN e USING (parent_prod_id)),
fitted AS (SELECT * FROM z WHERE split = 'train'), all_known AS (SELECT * FROM z WHERE split <> 'test'),
{_specs({'all': 'range(1, 41)'})}, {_eliminated('fitted', 'specs', 'models')},
grid_scores AS (SELECT alpha, sqrt(avg(pow(greatest(1.0::DOUBLE, least(5.0::DOUBLE, b + list_inner_product(x, w))) - y, 2))) AS rmse
  FROM z CROSS JOIN models WHERE split = 'val' GROUP BY alpha),
best AS (SELECT * FROM specs WHERE alpha = (SELECT alpha FROM grid_scores ORDER BY rmse, alpha LIMIT 1)),
{_eliminated('all_known', 'best', 'final')},
scored AS (SELECT vec_id AS id, split, y, greatest(1.0::DOUBLE, least(5.0::DOUBLE, b + list_inner_product(x, w))) AS rating
  FROM z CROSS JOIN final)"""

def _per_key(name: str) -> list[tuple[str, str, str]]:
    """``(query, key, prefix)``: the product key's query has the plain name."""
    return [(name if p == "prod" else f"{name}_{p}", k, p) for k, p in KEY_PREFIXES.items()]


PART = f"""'part-' || ({HASH.format("'7:' || id::VARCHAR")} % 100 % 3)"""
SHARES = "(0.0), (0.01), (0.25), (0.5), (0.75), (0.95), (1.0)"

SIMPLEX = f"""{REVIEWS}, {_loo('reviews')},
errors AS (SELECT id, rating, greatest(1.0, least(5.0, user_loo_avg))::DOUBLE AS pa, greatest(1.0, least(5.0, prod_loo_avg))::DOUBLE AS pb,
  greatest(1.0, least(5.0, parent_loo_avg))::DOUBLE AS pc, pa - rating AS a, pb - rating AS b, pc - rating AS c FROM encoded),
s AS (SELECT avg(a * a) AS aa, avg(b * b) AS bb, avg(c * c) AS cc, avg(a * b) AS ab, avg(a * c) AS ac, avg(b * c) AS bc FROM errors),
edges AS (
  SELECT 1.0 - t AS wa, t AS wb, 0.0 AS wc FROM (SELECT greatest(0.0, least(1.0, (aa - ab) / (aa + bb - 2 * ab))) AS t FROM s)
  UNION ALL SELECT 1.0 - t, 0.0, t FROM (SELECT greatest(0.0, least(1.0, (aa - ac) / (aa + cc - 2 * ac))) AS t FROM s)
  UNION ALL SELECT 0.0, 1.0 - t, t FROM (SELECT greatest(0.0, least(1.0, (bb - bc) / (bb + cc - 2 * bc))) AS t FROM s)),
inner_d AS (SELECT aa + cc - 2 * ac AS d11, bb + cc - 2 * bc AS d22, ab - ac - bc + cc AS d12, ac - cc AS e1, bc - cc AS e2 FROM s),
inside AS (SELECT (d12 * e2 - d22 * e1) / (d11 * d22 - d12 * d12) AS wa, (d12 * e1 - d11 * e2) / (d11 * d22 - d12 * d12) AS wb FROM inner_d),
candidates AS (SELECT wa, wb, wc FROM edges UNION ALL
  SELECT wa, wb, 1.0 - wa - wb FROM inside WHERE wa >= 0 AND wb >= 0 AND wa + wb <= 1),
best AS (SELECT wa, wb, wc, wa * wa * aa + wb * wb * bb + wc * wc * cc + 2 * (wa * wb * ab + wa * wc * ac + wb * wc * bc) AS mse
  FROM candidates CROSS JOIN s ORDER BY mse LIMIT 1)"""


def _replicates(predictions: dict[str, str], rows: str, count: int) -> str:
    """CTE ``sums``: weights and squared errors per Poisson replicate; replicate 0 has every row once."""
    steps = []
    share = 0.0
    for k in range(8):
        share += math.exp(-1) / math.factorial(k)
        steps.append(math.floor(65536 * share))
    weight = " + ".join(f"(h >= {step})::INTEGER" for step in steps)
    models = " UNION ALL ".join(
        f"SELECT r AS replicate, '{name}' AS model, sum(w)::BIGINT AS weight, sum(w * pow(greatest(1.0, least(5.0, {p})) - y, 2)) AS squared FROM drawn GROUP BY 1"
        for name, p in predictions.items()
    )
    return f"""digests AS (SELECT scored.*, d, md5('42:' || d || ':' || id) AS digest FROM {rows} AS scored CROSS JOIN range({count // 8}) t(d)),
slots AS (SELECT digests.*, d * 8 + k + 1 AS r, ('0x' || substr(digest, (k * 4 + 1)::INTEGER, 4))::BIGINT AS h FROM digests CROSS JOIN range(8) u(k)),
drawn AS (SELECT * EXCLUDE (d, digest, h), {weight} AS w FROM slots WHERE {weight} > 0
  UNION ALL SELECT *, 0, 1 FROM {rows}),
sums AS ({models})"""


def _intervals(against: str, digits: int) -> str:
    return f"""SELECT s.model, round(max(CASE WHEN replicate = 0 THEN s.rmse END), {digits}) + 0.0 AS rmse,
  round(max(CASE WHEN replicate = 0 THEN s.rmse - o.rmse END), {digits}) + 0.0 AS difference,
  round(quantile_cont(CASE WHEN replicate > 0 THEN s.rmse - o.rmse END, 0.025), {digits}) + 0.0 AS low,
  round(quantile_cont(CASE WHEN replicate > 0 THEN s.rmse - o.rmse END, 0.975), {digits}) + 0.0 AS high
FROM (SELECT replicate, model, sqrt(squared / weight) AS rmse FROM sums) s
JOIN (SELECT replicate, sqrt(squared / weight) AS rmse FROM sums WHERE model = '{against}') o USING (replicate) GROUP BY 1"""


BASELINE_SUMS = f"""{REVIEWS}, {_loo('reviews')}, mean AS (SELECT avg(rating) AS m FROM reviews),
predicted AS (SELECT id, rating AS y, m, user_loo_avg AS u, prod_loo_avg AS p, parent_loo_avg AS q FROM encoded CROSS JOIN mean),
{_replicates({"prior": "m", "user": "u", "prod": "p", "parent": "q"}, "predicted", 40)}"""


ORACLE: dict[str, str] = {
    "scan_csv_reviews": f"WITH {REVIEWS} SELECT * FROM reviews",
    "scan_csv_texts": f"WITH {TEXTS} SELECT * FROM texts",
    "scan_csv_inferred": f"WITH {REVIEWS} SELECT id, user_id::BIGINT AS user_id, rating, votes, purchased FROM reviews",
    "scan_pruned": f"WITH {REVIEWS} SELECT id, rating, purchased, votes FROM reviews",
    **{
        name: f"WITH {REVIEWS} SELECT {k}, avg(rating) AS {p}_avg, count(*) AS {p}_cnt FROM reviews GROUP BY 1"
        for name, k, p in _per_key("read_stats_parquet")
    },
    "write_stats_parquet": f"WITH {REVIEWS} "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS key_name, {k} AS key, sum(rating)::BIGINT AS rating_sum, count(rating) AS rating_count, "
        f"avg(rating) AS rating_mean FROM reviews GROUP BY {k}"
        for k in KEY_PREFIXES
    ),
    "global_avg_artifact": f"WITH {REVIEWS} SELECT avg(rating) AS global_avg FROM reviews",
    "embedding_store": f"""WITH {WORDS}, {_hashed('words')} SELECT id, 1::BIGINT AS copies, 32::BIGINT AS width,
  round(sum(value), 6) + 0.0 AS total, round(max(value) FILTER (pos = 0), 6) + 0.0 AS first FROM hashed GROUP BY id""",
    "write_submission": f"WITH {PAIRS} SELECT id, rating FROM blended",
    "write_metrics": f"""WITH {PAIRS} SELECT (SELECT round(sqrt(avg(pow(rating_a - rating, 2))), 6) FROM pairs) AS best_val_rmse,
  min(rating) AS min, max(rating) AS max, round(avg(rating), 6) AS mean FROM blended""",
    "concat_review_text": f"WITH {TEXTS} SELECT id, text FROM joined",
    "text_length": f"WITH {TEXTS} SELECT id, length(text)::BIGINT AS text_len FROM joined",
    "log_count": f"""WITH {REVIEWS} SELECT user_id, count(rating) AS rating_count,
  round(ln(1 + count(rating)::DOUBLE), 9) AS log_count FROM reviews GROUP BY user_id""",
    "votes_log1p_clipped": f"WITH {REVIEWS} SELECT id, round({VOTES_LOG}, 9) + 0.0 AS votes_log FROM reviews",
    "purchased_flag": f"WITH {REVIEWS} SELECT id, {FLAG} AS purchased FROM reviews",
    "votes_fill": f"WITH {REVIEWS} SELECT id, {VOTES} AS votes FROM reviews",
    "fill_prior": f"""WITH {REVIEWS} SELECT id, coalesce(CASE WHEN purchased THEN rating::DOUBLE END,
  (SELECT avg(rating) FROM reviews)) AS rating FROM reviews""",
    "clip_rating": f"""WITH {REVIEWS} SELECT id, CASE WHEN votes IS NULL THEN NULL
  ELSE greatest(1.0::DOUBLE, least(5.0::DOUBLE, rating + 0.5::DOUBLE * votes)) END AS rating FROM reviews""",
    "conditional_prior": f"""WITH {REVIEWS} SELECT prod_id, CASE WHEN count(rating) > 1 THEN avg(rating)
  ELSE (SELECT avg(rating) FROM reviews) END AS prod_avg FROM reviews GROUP BY prod_id""",
    "standardize": f"""WITH {SPLIT_TABLES}, {_moments(NUMERIC, "features WHERE split = 'train'")}
SELECT id, split, {_scaled(NUMERIC, ' + 1e-8')} FROM features, moments""",
    "standardize_unbounded": f"""WITH {REVIEWS}, {_narrowed('reviews', 'slim')}, {_totals('slim')},
features AS MATERIALIZED ({_others('slim', 'slim', VOTES_LOG)}), {_moments(UNBOUNDED, 'features')}
SELECT id, {_round(['user_avg', 'prod_avg', 'parent_avg'], 6)}, {_scaled(UNBOUNDED)} FROM features, moments""",
    "assemble_features": f"""WITH {REVIEWS}, {_loo('reviews')},
features AS ({_numeric('encoded', 'loo_avg', VOTES_LOG)})
SELECT id, {', '.join(f'round({c}, 9) + 0.0 AS f{i}' for i, c in enumerate(STATS_FIRST))} FROM features""",
    "assemble_embedding": """WITH arrays AS (SELECT vec_id AS id, list_concat(embedding::DOUBLE[],
    [label::DOUBLE, (embedding[1] >= 0)::INTEGER::DOUBLE]) AS f FROM embeddings)
SELECT id, (unnest(range(len(f))))::INTEGER AS pos, round(unnest(f), 6) + 0.0 AS value FROM arrays""",
    "feature_subset": f"""WITH {REVIEWS}, {_loo('reviews')},
features AS ({_numeric('encoded', 'loo_avg', extra=', parent_prod_id')}),
{PRODUCT_EMBEDDINGS}
SELECT id, {SUBSET_COLUMNS} FROM features JOIN e USING (parent_prod_id)""",
    "global_avg": f"WITH {REVIEWS} SELECT avg(rating) AS global_avg FROM reviews",
    **{f"group_stats_{p}": f"WITH {REVIEWS} {_group_stats(k)}" for k, p in KEY_PREFIXES.items()},
    **{
        f"group_avg_count_{p}": f"WITH {REVIEWS} SELECT {k}, avg(rating) AS {p}_avg, count(*) AS {p}_cnt FROM reviews GROUP BY 1"
        for k, p in KEY_PREFIXES.items()
    },
    "text_length_profile": f"""WITH {TEXTS} SELECT avg(length(text)) AS avg_text_len,
  min(length(text))::BIGINT AS min_text_len, max(length(text))::BIGINT AS max_text_len FROM joined""",
    "token_coverage": f"""WITH {WORDS} SELECT count(*) AS texts,
  round(avg((len(words) <= 192)::INTEGER), 9) AS share_within,
  round(quantile_cont(len(words), 0.95), 9) AS p95_words FROM words""",
    "rating_distribution": f"""WITH {REVIEWS} SELECT rating, count(*) AS reviews,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM reviews), 9) AS percent FROM reviews GROUP BY 1""",
    "entity_summary": f"""WITH {REVIEWS}, sizes AS (SELECT
  (SELECT count(*) FROM reviews) AS reviews,
  (SELECT count(*) FROM (SELECT DISTINCT user_id FROM reviews)) AS users,
  (SELECT count(*) FROM (SELECT DISTINCT prod_id FROM reviews)) AS products,
  (SELECT count(*) FROM (SELECT DISTINCT parent_prod_id FROM reviews)) AS parents)
SELECT *, reviews / users::DOUBLE AS reviews_per_user, reviews / products::DOUBLE AS reviews_per_product FROM sizes""",
    "row_counts": f"WITH {SPLIT} SELECT split AS name, count(*) AS row_count FROM split GROUP BY 1",
    "prediction_stats": f"""WITH {PAIRS} SELECT min(rating) AS min, max(rating) AS max, round(avg(rating), 6) AS mean,
  round(stddev_pop(rating), 6) AS std FROM blended""",
    "rmse": f"WITH {PAIRS} SELECT round(sqrt(avg(pow(rating_a - rating, 2))), 9) AS rmse FROM pairs",
    "prediction_corr": f"WITH {PAIRS} SELECT round(corr(rating_a, rating_b), 6) AS correlation FROM pairs",
    "masked_mean_pool": """WITH flat AS (SELECT label, (embedding[1] >= 0)::INTEGER AS mask, unnest(range(len(embedding))) AS pos,
  unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT label, pos::INTEGER AS pos, round(sum(mask * x) / greatest(sum(mask), 1e-9), 6) + 0.0 AS value
FROM flat GROUP BY 1, 2""",
    **{f"loo_encode_{p}": _loo_query(k, p) for k, p in KEY_PREFIXES.items()},
    **{name: _loo_query("user_id", "user") for name in ("loo_encode_window", "loo_encode_hot", "loo_encode_window_hot")},
    "loo_full_frame": _loo_query("parent_prod_id", "parent"),
    **{f"group_mean_encode_{p}": _group_mean_encode(k) for k, p in KEY_PREFIXES.items()},
    "loo_all_keys": LOO_FEATURES,
    "loo_all_keys_window": LOO_FEATURES,
    "feature_job_test": f"""WITH {SPLIT}, {_lookup()} SELECT id, user_avg, user_cnt, prod_avg, prod_cnt,
  parent_avg, parent_cnt, {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM looked_up""",
    "feature_job_lookups": f"WITH {SPLIT}, {_lookup()} "
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{k}' AS key_name, {k} AS key, {p}_avg AS avg, {p}_cnt AS cnt FROM looked_up"
        for k, p in KEY_PREFIXES.items()
    ),
    "incremental_totals": f"WITH {CORRECTED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS key_name, {key} AS key, sum(rating)::BIGINT AS rating_sum, count(rating) AS rating_count, "
        f"avg(rating) AS rating_mean, count(*) AS row_count FROM corrected {group}"
        for name, key, group in [("all_rows", "NULL", ""), *((k, k, f"GROUP BY {k}") for k in KEY_PREFIXES)]
    ),
    "incremental_loo": f"""WITH {CORRECTED}, {_loo('corrected')} SELECT id, user_loo_avg, user_cnt, prod_loo_avg,
  prod_cnt, parent_loo_avg, parent_cnt, {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM encoded""",
    "lookup_join_bucketed": f"""WITH {SPLIT}, {_lookup()} SELECT id, user_avg, user_cnt, prod_avg, prod_cnt,
  parent_avg, parent_cnt, {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM looked_up""",
    "lookup_join_hot": f"""WITH {SPLIT}, {_lookup(keys={'user_id': 'user'})}
SELECT id, user_avg, user_cnt, round(user_log_cnt, 9) + 0.0 AS user_log_cnt FROM looked_up""",
    "feature_job": f"""WITH {SPLIT}, {_loo('train')} SELECT id, user_loo_avg, user_cnt, prod_loo_avg, prod_cnt,
  parent_loo_avg, parent_cnt, {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM encoded""",
    "lookup_join_stats": f"""WITH {SPLIT}, {_lookup()} SELECT id, user_avg, user_cnt, prod_avg, prod_cnt,
  parent_avg, parent_cnt, {_round(['user_log_cnt', 'prod_log_cnt', 'parent_log_cnt'], 9)} FROM looked_up""",
    **{
        name: f"""WITH {SPLIT}, {_lookup(keys={k: p}, count='count(rating)')}
SELECT id, {p}_avg, round({p}_log_cnt, 9) + 0.0 AS {p}_log_cnt FROM looked_up"""
        for name, k, p in _per_key("map_encode")
    },
    "join_embeddings": f"""WITH {TEXTS} SELECT id, vec_id IS NOT NULL AS matched, length(text)::BIGINT AS text_len,
  len(embedding)::BIGINT AS width, round(list_sum(embedding::DOUBLE[]), 5) + 0.0 AS total
FROM joined LEFT JOIN embeddings ON id = vec_id""",
    "embedding_alignment": """WITH ids AS (SELECT doc_id, vec_id FROM documents FULL JOIN embeddings ON doc_id = vec_id)
SELECT count(doc_id) AS left_rows, count(vec_id) AS right_rows, count(CASE WHEN doc_id = vec_id THEN 1 END) AS shared_ids,
  count(CASE WHEN vec_id IS NULL THEN 1 END) AS left_only_ids,
  count(CASE WHEN doc_id IS NULL THEN 1 END) AS right_only_ids FROM ids""",
    "join_predictions": f"WITH {PAIRS} SELECT id, rating_a, rating_b FROM pairs",
    "product_metadata_join": f"""WITH {REVIEWS} SELECT id, parent_prod_id, rating, p_type AS main_category,
  p_retailprice AS price FROM reviews LEFT JOIN part ON parent_prod_id = p_partkey::VARCHAR""",
    "holdout_split": f"""WITH {REVIEWS} SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), id) <= 500
  THEN 'val' ELSE 'train' END AS split FROM reviews""",
    "fraction_split": f"WITH {SPLIT} SELECT id, split FROM split",
    "subset_sample": f"""WITH {REVIEWS}, ranked AS (SELECT id, row_number() OVER (ORDER BY md5('42:' || id), id) AS r FROM reviews)
SELECT id, 'train' AS split FROM ranked WHERE r > 500 AND r <= 20500""",
    **{
        name: f"""WITH {SPLIT}, {_lookup(keys={k: p})} SELECT DISTINCT {k}, {p}_avg, {p}_cnt FROM looked_up"""
        for name, k, p in _per_key("distinct_lookup")
    },
    "best_by_rmse": f"WITH {BASELINES} SELECT predictor, round(rmse, 9) AS rmse FROM baselines ORDER BY rmse, predictor LIMIT 1",
    "tokenize_truncate_pad": f"""WITH {WORDS} SELECT id, len(words)::BIGINT AS n_tokens, 192::BIGINT AS width,
  least(len(words), 192)::BIGINT AS mask_sum,
  md5(list_aggregate(list_resize(words, 192, '[PAD]'), 'string_agg', ' ')) AS tokens_md5 FROM words""",
    "vocabulary": f"WITH {WORDS}, {VOCABULARY.format(1)} SELECT token, token_count, token_id FROM vocab",
    "encode_token_ids": f"""WITH {WORDS}, {VOCABULARY.format(2)},
flat AS (SELECT id, unnest(words[1:192]) AS token, unnest(range(1, least(len(words), 192) + 1)) AS pos FROM words),
ids AS (SELECT id, pos, coalesce(token_id, 1) AS token_id FROM flat LEFT JOIN vocab USING (token))
SELECT words.id, 192::BIGINT AS width, count(pos) AS mask_sum, coalesce(sum(pos * token_id), 0)::BIGINT AS weighted_ids
FROM words LEFT JOIN ids ON words.id = ids.id GROUP BY 1""",
    "encode_token_ids_whole": f"""WITH {WORDS}, {VOCABULARY.format(2)},
flat AS (SELECT id, unnest(words) AS token, unnest(range(1, len(words) + 1)) AS pos FROM words),
ids AS (SELECT id, pos, coalesce(token_id, 1) AS token_id FROM flat LEFT JOIN vocab USING (token))
SELECT words.id, count(pos) AS width, count(pos) AS mask_sum, coalesce(sum(pos * token_id), 0)::BIGINT AS weighted_ids
FROM words LEFT JOIN ids ON words.id = ids.id GROUP BY 1""",
    **{
        name: f"""WITH {WORDS}, {_hashed('words')}
SELECT id, pos::INTEGER AS pos, round(value, 6) + 0.0 AS value FROM hashed"""
        for name in ("encode_batches", "hashed_embeddings")
    },
    "encode_tfidf": f"""WITH {WORDS},
counts AS (SELECT id, {HASH.format('word')} % 256 AS pos, count(*) AS tf
  FROM (SELECT id, unnest(words) AS word FROM words) GROUP BY 1, 2),
weights AS (SELECT pos, ln(((SELECT count(*) FROM words) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM counts GROUP BY 1),
grid AS (SELECT id, unnest(range(256)) AS pos FROM words)
SELECT grid.id, grid.pos::INTEGER AS pos, round((coalesce(tf * idf, 0.0))::FLOAT::DOUBLE, 5) + 0.0 AS value
FROM grid LEFT JOIN counts ON grid.id = counts.id AND grid.pos = counts.pos LEFT JOIN weights ON grid.pos = weights.pos""",
    "gram_matrix": f"""WITH z AS (SELECT CASE WHEN {HASH.format("'42:' || vec_id::VARCHAR")} % 100 < 80 THEN 'train' ELSE 'val' END AS split,
  vec_id, list_concat(list_concat([1.0::DOUBLE], embedding::DOUBLE[]), [label::DOUBLE]) AS z FROM embeddings),
flat AS (SELECT split, vec_id, unnest(range(len(z))) AS i, unnest(z) AS x FROM z)
SELECT a.split, a.i::INTEGER AS i, b.i::INTEGER AS pos, round(sum(a.x * b.x), 4) + 0.0 AS value
FROM flat a JOIN flat b ON a.vec_id = b.vec_id GROUP BY 1, 2, 3""",
    "ridge_leave_one_out": LEAVE_ONE_OUT,
    "ridge_fit": RIDGE_FIT,
    "ridge_fit_mllib": RIDGE_FIT,
    "ridge_fit_embeddings": f"""WITH RECURSIVE {EMBEDDED}, {_specs({'all': 'range(1, 65)'}, (1.0,))}, {_eliminated('z', 'specs', 'model')},
solved AS (SELECT list_prepend(b, w) AS v FROM model)
SELECT (unnest(range(len(v))))::INTEGER AS pos, round(unnest(v), 6) + 0.0 AS value FROM solved""",
    "ridge_alpha_grid_embeddings": f"""WITH RECURSIVE {EMBEDDED}, train AS (SELECT * FROM z WHERE split = 'train'),
{_specs({'all': 'range(1, 65)'})}, {_eliminated('train', 'specs', 'models')}
SELECT alpha, {VAL_RMSE} FROM z CROSS JOIN models WHERE split = 'val' GROUP BY alpha""",
    "ridge_alpha_grid": f"WITH {GRID} SELECT alpha, round(rmse, 9) AS rmse FROM grid",
    "predict_clip": f"""WITH {GRID}, best AS (SELECT alpha FROM grid ORDER BY rmse, alpha LIMIT 1),
{_raw_moments('raw', 'all_m')}, {_ridge('all_m', 'best', 'final')}
SELECT id, round(greatest(1.0::DOUBLE, least(5.0::DOUBLE, b + wp * p + wv * v)), 6) AS rating FROM raw CROSS JOIN final""",
    "loo_baseline_rmse": f"WITH {BASELINES} SELECT predictor, round(rmse, 9) AS rmse FROM baselines",
    "blend_weight_sweep": f"""WITH {PAIRS}, weights AS (SELECT unnest([{', '.join(f'{w}::DOUBLE' for w in BLEND_WEIGHTS)}]) AS weight),
swept AS (SELECT weight, greatest(1.0::DOUBLE, least(5.0::DOUBLE, weight * rating_a + (1.0 - weight) * rating_b)) AS r
  FROM pairs CROSS JOIN weights)
SELECT weight, round(min(r), 6) AS min, round(max(r), 6) AS max, round(avg(r), 6) AS mean FROM swept GROUP BY 1""",
    "weighted_blend": f"""WITH {PAIRS} SELECT id, round(greatest(1.0::DOUBLE, least(5.0::DOUBLE,
  0.5::DOUBLE * rating_a + 0.5::DOUBLE * rating_b)), 9) AS rating FROM pairs""",
    "blend_final": f"WITH {PAIRS} SELECT id, round(rating, 9) AS rating FROM blended",
    "ablation_table": ABLATION,
    "gbt_single_tree": f"""WITH {RAW}, {_stump('raw')} SELECT 'gbt' AS model, 'raw' AS features, rmse FROM stump""",
    "gbt_histogram": f"""WITH {SPLIT_TABLES}, {_forest(3, 2, 32, 4096)}
SELECT id, round(greatest(1.0::DOUBLE, least(5.0::DOUBLE, p / 1000000.0::DOUBLE)), 6) + 0.0 AS rating FROM fitted_3 WHERE split = 'val'""",
    "gbt_histogram_trees": f"WITH {SPLIT_TABLES}, {_forest(3, 2, 32, 4096)} {_forest_nodes(3, 2)}",
    "cooccurrence_information": f"""WITH {PAIR_COUNTS}
SELECT word, other, n::BIGINT AS n, round(weight, 9) + 0.0 AS weight FROM information WHERE weight > 0""",
    "word_vector_step": f"""WITH {PAIR_COUNTS}
SELECT word, j::INTEGER AS pos, round(sum(weight * CASE WHEN ('0x' || substr(md5(j || ':' || other), 1, 4))::BIGINT % 2 = 0
  THEN 1.0 ELSE -1.0 END), 6) + 0.0 AS value FROM information CROSS JOIN range(8) r(j) WHERE weight > 0 GROUP BY 1, 2""",
    "submission_job": f"{SUBMISSION} SELECT id, round(rating, 5) + 0.0 AS rating FROM scored WHERE split = 'test'",
    "submission_metrics": f"""{SUBMISSION} SELECT round((SELECT min(rmse) FROM grid_scores), 5) AS best_val_rmse,
  round((SELECT sqrt(avg(pow(rating - y, 2))) FROM scored WHERE split <> 'test'), 5) AS train_rmse,
  round(min(rating), 5) AS min, round(max(rating), 5) AS max, round(avg(rating), 5) AS mean FROM scored WHERE split = 'test'""",
    "distinct_sketches": f"""WITH {REVIEWS}, parted AS (SELECT *, unnest([{PART}, 'all']) AS part_name FROM reviews),
flat AS (SELECT part_name, unnest(['user_id', 'prod_id', 'parent_prod_id']) AS key_name,
  unnest([user_id, prod_id, parent_prod_id]) AS key FROM parted)
SELECT part_name, key_name, count(*) AS row_count, count(DISTINCT key) + max((key IS NULL)::BIGINT) AS exact_count,
  true AS within_bound FROM flat GROUP BY 1, 2""",
    "quantile_summaries": f"""WITH {REVIEWS}, {WORDS}, sizes AS (SELECT 'time' AS measure, count(time) AS n_rows FROM reviews
  UNION ALL SELECT 'characters', count(length(text)) FROM joined UNION ALL SELECT 'words', count(len(words)) FROM words)
SELECT measure, share::DOUBLE AS share, n_rows, true AS within_bound FROM sizes CROSS JOIN (VALUES {SHARES}) v(share)""",
    "blend_simplex": f"""WITH {SIMPLEX}, rows AS (SELECT unnest(['user', 'prod', 'parent']) AS predictor,
  unnest([wa, wb, wc])::DOUBLE AS weight, sqrt(mse) AS rmse FROM best)
SELECT predictor, round(weight, 6) + 0.0 AS weight, round(rmse, 6) + 0.0 AS rmse FROM rows""",
    "blend_simplex_predictions": f"""WITH {SIMPLEX} SELECT id,
  round(greatest(1.0::DOUBLE, least(5.0::DOUBLE, wa * pa + wb * pb + wc * pc)), 5) + 0.0 AS rating FROM errors CROSS JOIN best""",
    "bootstrap_sums": f"""WITH {BASELINE_SUMS} SELECT replicate::INTEGER AS replicate, model, weight, round(squared, 3) + 0.0 AS squared FROM sums""",
    "bootstrap_intervals": f"WITH {BASELINE_SUMS} {_intervals('prior', 8)}",
    "encode_tfidf_slots": f"""WITH {WORDS},
counts AS (SELECT id, {HASH.format('word')} % 262144 AS slot, count(*) AS tf
  FROM (SELECT id, unnest(words) AS word FROM words) GROUP BY 1, 2),
weights AS (SELECT slot, ln(((SELECT count(*) FROM words) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM counts GROUP BY 1)
SELECT id, slot::INTEGER AS slot, round(tf * idf, 6) + 0.0 AS value FROM counts JOIN weights USING (slot)""",
}
