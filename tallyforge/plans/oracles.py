"""The registered queries again, as SQL for an independent engine on the same tables.

Written from the meaning of each query, not from the Spark plans: percentiles by row number,
covariance by self-join, regression by elimination, draws by a chain of sub-queries.
"""

from __future__ import annotations

from html.entities import name2codepoint

from tallyforge.functions.draws import PRIME, cubic
from tallyforge.functions.text import BLANKS, PUNCTUATION
from tallyforge.plans.inputs import ENDINGS
from tallyforge.plans.queries import (
    CATEGORIES, COEFFICIENTS, FLAGS, K, KEPT, MIN_USERS, RUNS, SEED, SPLIT_SEED, STATION_K, STATION_RUNS,
)
from tallyforge.sources.numeric import COVER_NAMES


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rounded(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0::DOUBLE"


# --- n-grams ---------------------------------------------------------------------------------

ASCII_LOWER = "translate(sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def ngrams(n: int, deleted: bool = False) -> str:
    if deleted:
        bare = f"regexp_replace({ASCII_LOWER}, '[{PUNCTUATION}]+', '', 'g')"
        parts = f"string_split_regex({bare}, '[{BLANKS}]+')"
    else:
        parts = f"string_split_regex(lower(sentence), '[{PUNCTUATION}{BLANKS}]+')"
    return f"""
        SELECT array_to_string(words[i:i + {n - 1}], ' ') AS ngram, count(*) AS count FROM (
            SELECT words, unnest(range(1, len(words) - {n - 2})) AS i FROM (
                SELECT list_filter({parts}, lambda x: x <> '') AS words FROM (
                    SELECT unnest(string_split(text, '. ')) AS sentence FROM documents)))
        GROUP BY 1"""


def ngram_top5(n: int) -> str:
    order = "ORDER BY count DESC, ngram"
    return f"SELECT count, ngram, CAST(row_number() OVER ({order}) AS INTEGER) AS rank FROM ({ngrams(n)}) {order} LIMIT 5"


NGRAM_ALL = " UNION ALL ".join(f"SELECT {n} AS n, rank, count, ngram FROM ({ngram_top5(n)})" for n in range(1, 6))

# --- messages and tokens ---------------------------------------------------------------------

POSTS = """
    SELECT 'u' || (conv_id % 97) AS user_id, text FROM conversations
    WHERE (conv_id * 31 + turn) % 20 NOT IN (0, 1) AND text IS NOT NULL"""

DIGIT = "CAST(user_id AS BIGINT) % 10"
GROUP = f"CASE WHEN {DIGIT} <= 6 THEN CAST({DIGIT} AS INTEGER) ELSE 7 END"


def decoded(text: str, amp: bool = True) -> str:
    names = ", ".join(
        f"{quoted('&' + n + ';')}: {quoted(chr(c))}" for n, c in name2codepoint.items() if n != "amp"
    )
    code = "CAST(regexp_extract(p, '^&#0*([0-9]+);$', 1) AS INTEGER)"
    number = f"""array_to_string(list_transform(
        regexp_extract_all({text}, '&#[0-9]+;|[^&]+|&', 0),
        lambda p: CASE WHEN regexp_full_match(p, '&#0*[0-9]{{1,7}};')
            THEN CASE WHEN {code} BETWEEN 0 AND 55295 OR {code} BETWEEN 57344 AND 1114111
                THEN chr({code}) ELSE p END ELSE p END), '')"""
    name = f"""array_to_string(list_transform(
        regexp_extract_all({number}, '&[A-Za-z0-9_]+;|[^&]+|&', 0),
        lambda q: coalesce(map_extract_value(MAP {{{names}}}, q), q)), '')"""
    return f"replace({name}, '&amp;', ' and ')" if amp else name


# The token classes once more, written out by hand rather than taken from the library.
_BLANK = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_FACES = r"[<>]?[:;=8]['*\-Oo]?[()/:@DP\[\\\]dp{|}]|[()/:@DP\[\\\]dp{|}]['*\-Oo]?[:;=8][<>]?"
_ADDRESS = r"(?i:http|https)://[!$-_a-z]+"
_PATTERN = "|".join(
    [
        rf"[+(](?:[-.(){_BLANK}]?[-.(){_BLANK}]?\p{{Nd}}){{7,15}}",
        rf"(?:\p{{Nd}}[-.(){_BLANK}]{{1,2}})?\p{{Nd}}{{3}}[-.(){_BLANK}]{{1,2}}(?:\p{{Nd}}{{3}}[-.(){_BLANK}]{{1,2}})?\p{{Nd}}{{4}}",
        _ADDRESS,
        _FACES,
        r"<[^>]+>",
        r"@[\p{L}\p{N}_]+",
        r"#[\p{L}\p{N}_]+(?:['-]+[\p{L}\p{N}_]+)*",
        r"\p{L}[\p{L}'_-]+\p{L}",
        r"[+-]?\p{Nd}+(?:[,./:]+\p{Nd}+)+",
        r"[\p{L}\p{N}_]+",
        rf"\.[.{_BLANK}]*\.",
        rf"[^{_BLANK}]",
    ]
)


def token_rows(table: str, text: str, keys: str = "") -> str:
    folded = f"""CASE WHEN regexp_full_match(t, {quoted(_FACES)})
        OR regexp_matches(t, {quoted(_ADDRESS)}) THEN t ELSE lower(t) END"""
    return f"""
        SELECT {keys} {folded} AS token FROM (
            SELECT {keys} unnest(regexp_extract_all({decoded(text)}, {quoted(_PATTERN)}, 0)) AS t
            FROM {table})"""


RICH = f"""(SELECT conv_id, coalesce(text, '') || ' ' ||
    [{", ".join(quoted(e) for e in ENDINGS)}][(conv_id * 31 + turn) % {len(ENDINGS)} + 1] AS text FROM conversations)"""

ESCAPED = """
    SELECT conv_id, turn, CASE WHEN NOT regexp_matches(text, '[^\\x{00}-\\x{7F}]') THEN text ELSE
        array_to_string(list_transform(regexp_extract_all(hex(text), '..', 0),
            lambda p: CASE p WHEN '09' THEN '\\t' WHEN '0A' THEN '\\n' WHEN '0D' THEN '\\r'
                WHEN '5C' THEN '\\\\' WHEN '27' THEN '\\''' ELSE
                CASE WHEN p BETWEEN '20' AND '7E' THEN chr(CAST('0x' || p AS INTEGER))
                     ELSE '\\x' || lower(p) END END), '') END AS escaped
    FROM conversations"""

MENTIONS = f"""
    SELECT DISTINCT user_id, token FROM ({token_rows(
        "(SELECT CAST(doc_id % 97 AS VARCHAR) AS user_id, text FROM documents)", "text", "user_id,")})"""
TOTALS = f"SELECT token, count(*) AS n_all FROM ({MENTIONS}) GROUP BY 1"
GROUP_COUNTS = f"""
    WITH mentions AS ({MENTIONS}),
    per_group AS (SELECT {GROUP} AS group_id, token, count(*) AS n_k FROM mentions GROUP BY 1, 2),
    totals AS (SELECT token, sum(n_k)::BIGINT AS n_all FROM per_group GROUP BY 1)
    SELECT group_id, token, n_k, n_all FROM per_group JOIN totals USING (token)
    WHERE n_all >= {MIN_USERS}"""


def relative(group_counts: str) -> str:
    return f"""
    SELECT group_id, rank, token, {rounded("score", 4)} AS score FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY group_id ORDER BY score DESC, token) AS INTEGER) AS rank
        FROM (SELECT *, log2(n_k / n_all) AS score FROM ({group_counts})))
    WHERE rank <= 10"""


RELATIVE = relative(GROUP_COUNTS)
# The same from the posts of the JSON lines, whose users are called u0, u1, ...
LINE_MENTIONS = f"""SELECT DISTINCT user_id, token FROM ({token_rows(f"(SELECT user_id[2:] AS user_id, text FROM ({POSTS}))", "text", "user_id,")})"""
MESSAGE_JOB = relative(GROUP_COUNTS.replace(MENTIONS, LINE_MENTIONS))

# --- classes and splits ----------------------------------------------------------------------


def bucket(seed: int, *ids: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({c} AS VARCHAR)" for c in ids]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def split_name(ids: tuple[str, ...], share: float) -> str:
    edge = int(share * (1 << 32))
    return f"CASE WHEN {bucket(SPLIT_SEED, *ids)} < {edge} THEN 'train' ELSE 'test' END"


LINE_IDS = ("l_orderkey", "l_linenumber", "l_partkey")
SHARES = f"""
    SELECT o_orderpriority AS label, count(*) AS n,
        {rounded("100.0 * count(*) / (SELECT count(*) FROM orders)", 4)} AS percent
    FROM orders GROUP BY 1"""
NAMES = ", ".join(f"({label}, {quoted(name)})" for label, name in COVER_NAMES)
NAMED_SHARES = f"""
    SELECT CAST(e.label AS DOUBLE) AS label, coalesce(name, 'no name') AS name, count(*) AS n,
        {rounded("100.0 * count(*) / (SELECT count(*) FROM embeddings)", 4)} AS percent
    FROM embeddings e LEFT JOIN (VALUES {NAMES}) AS c(label, name) ON e.label = c.label
    GROUP BY 1, 2"""
SAMPLE_SPLIT = f"""
    SELECT {split_name(LINE_IDS, 0.7)} AS set, count(*) AS n, {rounded("sum(l_quantity)", 2)} AS quantity
    FROM lineitem WHERE {bucket(1, *LINE_IDS)} < {int(0.1 * (1 << 32))} GROUP BY 1"""
TEST_CLASSES = f"""
    SELECT CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, count(*) AS n
    FROM embeddings WHERE {split_name(("vec_id",), 0.7)} = 'test' GROUP BY 1"""

# --- profiles --------------------------------------------------------------------------------


def days(gaps: bool = True) -> str:
    """Rows (station, measurement, year, vec_id, day, value) as recorded."""
    keep = "WHERE (vec_id * 7 + day - 1) % 23 <> 0" if gaps else ""
    return f"""
        SELECT * FROM (
            SELECT 'S' || ((vec_id // 2) % 40) AS station,
                CASE WHEN vec_id % 2 = 0 THEN 'TMAX' ELSE 'TMIN' END AS measurement,
                CAST(1900 + (vec_id // 2) // 40 AS INTEGER) AS year, vec_id,
                unnest(CAST(embedding AS DOUBLE[])) AS value,
                CAST(generate_subscripts(embedding, 1) AS INTEGER) AS day
            FROM embeddings) {keep}"""


PROFILE = f"""
    SELECT measurement, day, avg(value) AS mean, var_pop(value) AS var, count(*) AS ne
    FROM ({days()}) GROUP BY 1, 2"""
BAND = f"""
    SELECT measurement, day, {rounded("mean")} AS mean, {rounded("sqrt(var)")} AS std,
        {rounded("mean - sqrt(var)")} AS low, {rounded("mean + sqrt(var)")} AS high
    FROM ({PROFILE})"""
MISSING = f"""
    SELECT station, measurement, day, count(*) AS rows,
        count(*) FILTER (WHERE (vec_id * 7 + day - 1) % 23 <> 0) AS recorded,
        count(*) FILTER (WHERE (vec_id * 7 + day - 1) % 23 = 0) AS missing
    FROM ({days(gaps=False)}) GROUP BY 1, 2, 3"""


def tail(per_mille: int) -> str:
    rank = f"greatest((n * {per_mille} + 999) // 1000, 1)"
    return f"min(value) FILTER (WHERE place = {rank})"


STATS = f"""
    SELECT measurement, max(n) AS n, {rounded("avg(value)")} AS mean,
        {rounded("stddev_pop(value)")} AS std, {tail(1)} AS low1000, {tail(10)} AS low100,
        {tail(990)} AS high100, {tail(999)} AS high1000
    FROM (SELECT event_type AS measurement, value,
            count(*) OVER (PARTITION BY event_type) AS n,
            row_number() OVER (PARTITION BY event_type ORDER BY value) AS place
        FROM events WHERE value IS NOT NULL)
    GROUP BY 1"""
HISTOGRAM = f"""
    SELECT measurement, CAST(floor((value - low100) / 5) AS INTEGER) AS bin,
        {rounded("any_value(low100) + 5 * floor((value - low100) / 5)")} AS lo, count(*) AS n
    FROM events JOIN ({STATS}) s ON event_type = measurement
    WHERE value BETWEEN low100 AND high100
    GROUP BY measurement, floor((value - low100) / 5)"""
FLATTENED = " UNION ALL ".join(
    f"""SELECT 'V' || vec_id AS station, '{name}' AS measurement, label AS year,
        CAST(len(embedding[{a}:{b}]) AS INTEGER) AS days,
        {rounded(f"list_sum(CAST(embedding[{a}:{b}] AS DOUBLE[]))")} AS total FROM embeddings"""
    for name, a, b in (("TMAX", 1, 32), ("TMIN", 33, 64))
)
DERIVED = f"""
    WITH d AS ({days()}),
    both_ AS (SELECT station, year, day, a.value AS hi, b.value AS lo
        FROM (SELECT * FROM d WHERE measurement = 'TMAX') a
        JOIN (SELECT * FROM d WHERE measurement = 'TMIN') b USING (station, year, day))
    SELECT station, 'TAVG' AS measurement, year, day, {rounded("(hi + lo) / 2")} AS value FROM both_
    UNION ALL
    SELECT station, 'TRANGE', year, day, {rounded("hi - lo")} FROM both_"""
SELECTED = f"""
    SELECT station, year, day, {rounded("value")} AS value FROM ({days()})
    WHERE measurement = 'TMAX' AND station = 'S7' AND year = 1901"""


STORED = f"""
    SELECT * FROM ({STATS}) WHERE measurement <> 'click'
    UNION ALL SELECT * FROM ({STATS.replace("FROM events WHERE", "FROM (SELECT event_type, value * 2 AS value FROM events) WHERE")})
    WHERE measurement = 'click'"""
CSV_REPORT = f"""
    SELECT CASE kind WHEN 0 THEN 'malformed' WHEN 2 THEN 'malformed' WHEN 1 THEN 'empty cell' ELSE 'sound' END AS reason,
        count(*) AS n, count(*) FILTER (WHERE kind IN (0, 2)) AS records,
        {rounded("sum(l_extendedprice) FILTER (WHERE kind > 2)", 2)} AS price
    FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 100 AS kind FROM lineitem) GROUP BY 1"""


def covariance(gaps: bool) -> str:
    return f"""
        SELECT a.measurement, a.day AS i, b.day AS j, count(*) AS n, covar_pop(a.value, b.value) AS cov
        FROM ({days(gaps)}) a JOIN ({days(gaps)}) b USING (vec_id) GROUP BY ALL"""


INVARIANTS = f"""
    SELECT measurement, {rounded("sum(cov) FILTER (WHERE i = j)")} AS trace,
        {rounded("sum(cov * cov)")} AS frobenius
    FROM ({covariance(False)}) GROUP BY 1"""

IDENTITY = f"""
    SELECT measurement, count(DISTINCT vec_id) AS n, {rounded("sum(rest * rest)")} AS energy,
        0.0::DOUBLE AS error
    FROM (SELECT *, value - avg(value) OVER (PARTITION BY measurement, day) AS rest
        FROM ({days(False)})) GROUP BY 1"""

# Two-entry vectors: eigenvalues and vectors of a 2 x 2 matrix in closed form.
LINES = """
    WITH l AS (SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey AS station,
        l_returnflag AS measurement, l_linenumber AS year, l_quantity AS x,
        l_extendedprice / 1000 AS y FROM lineitem),
    c AS (SELECT measurement, avg(x) AS mx, avg(y) AS my, var_pop(x) AS a, covar_pop(x, y) AS b,
        var_pop(y) AS d FROM l GROUP BY 1),
    e AS (SELECT *, (a + d) / 2 + s * sqrt(((a - d) / 2) ** 2 + b * b) AS eigval, rank
        FROM c CROSS JOIN (VALUES (1, 1), (2, -1)) AS t(rank, s)),
    u AS (SELECT *, b / sqrt(b * b + (eigval - a) ** 2) AS p,
        (eigval - a) / sqrt(b * b + (eigval - a) ** 2) AS q FROM e),
    v AS (SELECT measurement, mx, my, rank, eigval,
        p * sign(CASE WHEN abs(p) >= abs(q) THEN p ELSE q END) AS v1,
        q * sign(CASE WHEN abs(p) >= abs(q) THEN p ELSE q END) AS v2 FROM u),
    r AS (SELECT station, measurement, year, (x - mx) * v1 + (y - my) * v2 AS coeff,
        ((x - mx) * v2 - (y - my) * v1) ** 2 / 2 AS mse
        FROM l JOIN v USING (measurement) WHERE rank = 1)"""
LINE_COMPONENTS = f"""{LINES}
    SELECT measurement, rank, {rounded("eigval")} AS eigval,
        {rounded("eigval / sum(eigval) OVER (PARTITION BY measurement)")} AS ratio,
        {rounded("sum(eigval) OVER (PARTITION BY measurement ORDER BY rank) / sum(eigval) OVER (PARTITION BY measurement)")}
            AS cumulative, {rounded("v1")} AS v1, {rounded("v2")} AS v2 FROM v"""
LINE_ERRORS = f"""{LINES}
    SELECT station, measurement, year, {rounded("coeff")} AS coeff, {rounded("mse")} AS mse FROM r"""
LINE_EXTREMES = f"""{LINES},
    ranked AS (SELECT *,
        row_number() OVER (PARTITION BY measurement ORDER BY mse, station, year) AS low,
        row_number() OVER (PARTITION BY measurement ORDER BY mse DESC, station, year) AS high FROM r)
    SELECT measurement, 'best' AS kind, CAST(low AS INTEGER) AS place, station, year, {rounded("mse")} AS error
    FROM ranked WHERE low <= 2
    UNION ALL
    SELECT measurement, 'worst', CAST(high AS INTEGER), station, year, {rounded("mse")} FROM ranked WHERE high <= 2"""


LINE_SERIES = f"""{LINES},
    w AS (SELECT r.*, l.x, l.y, mx, my, v1, v2,
        row_number() OVER (PARTITION BY measurement ORDER BY mse, r.station, r.year) AS low,
        row_number() OVER (PARTITION BY measurement ORDER BY mse DESC, r.station, r.year) AS high
        FROM r JOIN l USING (station, measurement, year) JOIN v USING (measurement) WHERE rank = 1),
    chosen AS (SELECT *, 'best' AS kind, low AS place FROM w WHERE low <= 2
        UNION ALL SELECT *, 'worst', high FROM w WHERE high <= 2),
    lines AS (SELECT *, 'original' AS series, [x, y] AS line FROM chosen
        UNION ALL SELECT *, 'mean', [mx, my] FROM chosen
        UNION ALL SELECT *, 'rank1', [mx + coeff * v1, my + coeff * v2] FROM chosen)
    SELECT measurement, kind, CAST(place AS INTEGER) AS place, station, year, series,
        CAST(day AS INTEGER) AS day, {rounded("line[day]")} AS value
    FROM lines CROSS JOIN (VALUES (1), (2)) AS t(day)"""
STATION_CTES = f"""{LINES},
    mean_ AS (SELECT 'S' || string_split(station, '-')[3] AS station, measurement, rank,
        avg((x - mx) * v1 + (y - my) * v2) AS c FROM l JOIN v USING (measurement) GROUP BY ALL),
    wide AS (SELECT station, {", ".join(
        f"max(c) FILTER (WHERE measurement = '{flag}' AND rank = {i + 1}) AS {flag}_coeff{i + 1}"
        for flag in FLAGS for i in range(KEPT)
    )} FROM mean_ GROUP BY station)"""
STATION_TABLE = f"""{STATION_CTES}
    SELECT station, {", ".join(f"{rounded(c)} AS {c}" for c in COEFFICIENTS)} FROM wide"""


def station_regression() -> str:
    facts = ["balance", "nation"]
    source = f"""{STATION_CTES}
        SELECT wide.*, s_acctbal::DOUBLE AS balance, s_nationkey::DOUBLE AS nation
        FROM wide JOIN supplier ON station = 'S' || s_suppkey
        WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*COEFFICIENTS, "s_acctbal", "s_nationkey"])}"""
    rows = " UNION ALL ".join(
        f"""SELECT '{t}' AS target, {rounded(f"b_balance_{t}", 9)} AS b_balance, {rounded(f"b_nation_{t}")} AS b_nation,
            {rounded(r2("train", [*facts, *COEFFICIENTS], facts, t))} AS r2_train,
            {rounded(r2("test", [*facts, *COEFFICIENTS], facts, t))} AS r2_test
            FROM train, test, solved_0 AS solved"""
        for t in COEFFICIENTS
    )
    return regression(source, ("station",), facts, COEFFICIENTS) + " " + rows


def ragged() -> str:
    """Station years with cut and missing vectors."""
    return """SELECT CASE vec_id % 3 WHEN 0 THEN 'TMAX' WHEN 1 THEN 'TMIN' END AS measurement,
        CASE WHEN vec_id % 50 = 3 THEN embedding[1:63] WHEN vec_id % 70 <> 5 THEN embedding END AS v FROM embeddings"""


CONTRACT = f"""
    SELECT measurement, count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS null_vectors,
        count(*) FILTER (WHERE len(v) <> 64) AS wrong_length, CAST(min(len(v)) AS INTEGER) AS shortest,
        CAST(max(len(v)) AS INTEGER) AS longest
    FROM ({ragged()}) GROUP BY 1"""
SOUND_DAYS = f"""
    SELECT measurement, CAST(day AS INTEGER) AS day, {rounded("avg(value)")} AS mean,
        {rounded("var_pop(value)")} AS var, count(*) AS ne
    FROM (SELECT measurement, unnest(v)::DOUBLE AS value, generate_subscripts(v, 1) AS day
        FROM ({ragged()}) WHERE len(v) = 64) GROUP BY ALL"""


def fixed_basis() -> str:
    def wave(j: int) -> str:
        return f"sqrt(2.0 / 64) * cos(pi() * (day - 0.5) * {j} / 64)"

    coefficients = ", ".join(f"sum(rest * {wave(j)}) AS c{j}" for j in (1, 2, 3))
    errors = ", ".join(
        rounded("avg((rest - (" + " + ".join(f"c{j} * {wave(j)}" for j in range(1, k + 1)) + ")) ** 2)")
        + f" AS mse{k}"
        for k in (1, 2, 3)
    )
    return f"""
        WITH d AS ({days(False)}),
        centred AS (SELECT *, value - avg(value) OVER (PARTITION BY measurement, day) AS rest FROM d),
        c AS (SELECT vec_id, {coefficients} FROM centred GROUP BY 1)
        SELECT station, measurement, year, {", ".join(f"{rounded(f'any_value(c{j})')} AS coeff{j}" for j in (1, 2, 3))},
            {errors}
        FROM centred JOIN c USING (vec_id) GROUP BY vec_id, station, measurement, year"""


# --- regression ------------------------------------------------------------------------------


def regression(
    source: str, ids: tuple[str, ...], features: list[str], targets: list[str], by: str = ""
) -> str:
    """CTEs ``train``/``test`` (counts, means, centred sums) and one elimination chain per model;
    the last CTE of model m is ``solved_m`` with columns b_<feature>_<target>.  With ``by`` there is
    one set of models for each of its values."""
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    columns = features + targets
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:] if a in features or a == b]
    moments = ", ".join(
        [f"avg({c}) AS m_{c}" for c in columns]
        + [f"covar_pop({a}, {b}) * count(*) AS s_{a}_{b}" for a, b in pairs]
    )
    ctes = [
        f"rows_ AS (SELECT {key}{', '.join(columns)}, {split_name(ids, 0.5)} AS set FROM ({source}))",
        *[
            f"{name} AS MATERIALIZED (SELECT {key}count(*) AS n, {moments} FROM rows_ WHERE set = '{name}'{group})"
            for name in ("train", "test")
        ],
    ]
    for number, removed in enumerate([None, *features]):
        use = [f for f in features if f != removed]
        cells = [(r, c) for r in use for c in use + targets]
        start = ", ".join(f"{product(columns, r, c)} AS e_{r}_{c}" for r, c in cells)
        ctes.append(f"m{number}_0 AS (SELECT {key}{start} FROM train)")
        for step, pivot in enumerate(use):
            swept = ", ".join(
                (
                    f"e_{pivot}_{c} / e_{pivot}_{pivot}"
                    if r == pivot
                    else f"e_{r}_{c} - e_{r}_{pivot} * e_{pivot}_{c} / e_{pivot}_{pivot}"
                )
                + f" AS e_{r}_{c}"
                for r, c in cells
            )
            ctes.append(f"m{number}_{step + 1} AS (SELECT {key}{swept} FROM m{number}_{step})")
        solved = ", ".join(f"e_{f}_{t} AS b_{f}_{t}" for f in use for t in targets)
        ctes.append(f"solved_{number} AS (SELECT {key}{solved} FROM m{number}_{len(use)})")
    return "WITH " + ",\n".join(ctes)


def product(columns: list[str], a: str, b: str) -> str:
    a, b = sorted((a, b), key=columns.index)
    return f"s_{a}_{b}"


def r2(name: str, columns: list[str], use: list[str], target: str) -> str:
    """Score of solved coefficients on set ``name`` (aliases train, test, solved)."""
    s = lambda a, b: f"{name}.{product(columns, a, b)}"
    cross = " + ".join(f"solved.b_{f}_{target} * {s(f, target)}" for f in use)
    square = " + ".join(
        f"solved.b_{f}_{target} * solved.b_{g}_{target} * {s(f, g)}" for f in use for g in use
    )
    shift = " - ".join(
        [f"({name}.m_{target} - train.m_{target})"]
        + [f"solved.b_{f}_{target} * ({name}.m_{f} - train.m_{f})" for f in use]
    )
    total = s(target, target)
    return f"(1 - ({total} - 2 * ({cross}) + ({square}) + {name}.n * ({shift}) ** 2) / {total})"


XS = [f"x{i}" for i in range(1, 5)]
# A row per vector and target: the first four entries against each of the others.
PROJECTED = "SELECT vec_id, " + ", ".join(
    f"CAST(embedding[{i}] AS DOUBLE) AS x{i}" for i in range(1, 5)
) + ", CAST(embedding[t + 4] AS DOUBLE) AS y, t FROM embeddings CROSS JOIN range(1, 61) r(t)"


def sensitivity() -> str:
    parts = []
    for number, removed in enumerate([None, *XS]):
        use = [x for x in XS if x != removed]
        scores = ", ".join(f"{r2(n, [*XS, 'y'], use, 'y')} AS {n}_score" for n in ("train", "test"))
        parts.append(
            f"SELECT 'y' || t AS target, '{removed or 'none'}' AS removed, {scores} "
            f"FROM train JOIN test USING (t) JOIN solved_{number} AS solved USING (t)"
        )
    body = ",\nscores AS (" + " UNION ALL ".join(parts) + ")"
    whole = "(PARTITION BY target)"
    decrease = lambda n: f"max({n}_score) FILTER (WHERE removed = 'none') OVER {whole} - {n}_score"
    return regression(PROJECTED, ("vec_id",), XS, ["y"], "t") + body + f"""
        SELECT target, removed, {rounded("train_score")} AS r2_train, {rounded("test_score")} AS r2_test,
            {rounded(decrease("train"))} AS decrease_train, {rounded(decrease("test"))} AS decrease_test
        FROM scores"""


def slopes() -> str:
    rows = " UNION ALL ".join(
        f"SELECT 'y' || t AS target, '{x}' AS feature, {rounded(f'b_{x}_y')} AS coefficient FROM solved_0" for x in XS
    )
    return regression(PROJECTED, ("vec_id",), XS, ["y"], "t") + " " + rows


def two_features() -> str:
    fs, t = ["l_quantity", "l_discount"], "l_extendedprice"
    intercept = f"train.m_{t} - " + " - ".join(f"b_{f}_{t} * train.m_{f}" for f in fs)
    return regression("SELECT * FROM lineitem", LINE_IDS, fs, [t]) + f"""
        SELECT {rounded(intercept, 3)} AS intercept, {rounded(f"b_l_quantity_{t}", 4)} AS b_quantity,
            {rounded(f"b_l_discount_{t}", 3)} AS b_discount,
            {rounded(r2("train", [*fs, t], fs, t))} AS r2_train, {rounded(r2("test", [*fs, t], fs, t))} AS r2_test,
            {rounded(r2("test", [*fs, t], fs, t) + " / " + r2("train", [*fs, t], fs, t))} AS ratio
        FROM train, test, solved_0 AS solved"""


PREDICTED = """
    WITH m AS (SELECT avg(l_extendedprice) AS y, avg(l_quantity) AS q, avg(l_discount) AS d,
        covar_pop(l_quantity, l_quantity) AS qq, covar_pop(l_quantity, l_discount) AS qd,
        covar_pop(l_discount, l_discount) AS dd, covar_pop(l_quantity, l_extendedprice) AS qy,
        covar_pop(l_discount, l_extendedprice) AS dy FROM lineitem),
    b AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS bq,
        (dy * qq - qy * qd) / (qq * dd - qd * qd) AS bd FROM m)
    SELECT l_orderkey, l_linenumber, l_partkey,
        round(y + bq * (l_quantity - q) + bd * (l_discount - d), 2) + 0.0::DOUBLE AS prediction
    FROM lineitem, b"""

# --- clustering ------------------------------------------------------------------------------

POINTS = "SELECT vec_id, CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
FIXED = f"""
    SELECT vec_id // {K} AS run, vec_id % {K} AS k, v AS c FROM ({POINTS}) WHERE vec_id < {RUNS * K}"""


def seed_chain() -> list[str]:
    """CTEs whose last, ``picks``, holds the drawn (run, place, id)."""
    draws = ", ".join(
        "(" + ", ".join(map(str, [run, place, *cubic(SEED, run, place, 0), *cubic(SEED, run, place, 1)])) + ")"
        for run in range(RUNS)
        for place in range(K)
    )

    def poly(half: int) -> str:
        a, b, c, d = (f"{x}{half}" for x in "abcd")
        return f"((({a} * h{half} + {b}) % {PRIME} * h{half} + {c}) % {PRIME} * h{half} + {d}) % {PRIME}"

    u = f"(({poly(1)}) * 2147483648.0::DOUBLE + {poly(2)} + 0.5) / 4611686018427387904.0::DOUBLE"
    number = lambda at: f"CAST('0x' || substr(md5(id), {at}, 15) AS BIGINT) % {PRIME}"
    ctes = [
        f"p AS MATERIALIZED (SELECT id, v, {number(1)} AS h1, {number(16)} AS h2 FROM ({POINTS}))",
        "draws AS (SELECT * FROM (VALUES "
        + draws
        + ") AS t(run, place, a1, b1, c1, d1, a2, b2, c2, d2))",
        f"""pick_0 AS MATERIALIZED (SELECT run, 0 AS place, arg_min(id, {{'t': -ln(1 - {u}), 'id': id}}) AS id
            FROM p, draws WHERE place = 0 GROUP BY run)""",
    ]
    for place in range(1, K):
        before = " UNION ALL ".join(f"SELECT * FROM pick_{i}" for i in range(place))
        ctes.append(f"""near_{place} AS MATERIALIZED (
            SELECT c.run, p.id, min(list_distance(p.v, q.v) ** 2) AS w
            FROM ({before}) c JOIN p q ON c.id = q.id CROSS JOIN p GROUP BY ALL)""")
        ctes.append(f"""pick_{place} AS MATERIALIZED (
            SELECT n.run, {place} AS place, arg_min(p.id, {{'t': -ln(1 - {u}) / w, 'id': p.id}}) AS id
            FROM near_{place} n JOIN p USING (id) JOIN draws d ON d.run = n.run AND d.place = {place}
            WHERE w > 0 GROUP BY n.run)""")
    rows = " UNION ALL ".join(f"SELECT * FROM pick_{i}" for i in range(K))
    return [*ctes, f"picks AS (SELECT CAST(run AS INTEGER) AS run, place, id FROM ({rows}))"]


def seeds() -> str:
    return "WITH " + ",\n".join(seed_chain()) + " SELECT * FROM picks"


def assigned(centers: str, points: str = POINTS) -> str:
    """run, vec_id, k, d2 of the nearest centre, lowest k on ties."""
    return f"""
        SELECT run, vec_id, any_value(v) AS v, min(list_distance(v, c)) ** 2 AS d2,
            arg_min(k, {{'d': list_distance(v, c), 'k': k}}) AS k
        FROM ({points}) CROSS JOIN ({centers}) GROUP BY run, vec_id"""


def rounds_from(points: str) -> str:
    """CTE of rounds from the centres in c_0 until a round's largest shift of a run is 0.1 or less; none after that."""
    return f"""rounds AS (
    SELECT 0 AS step, run, k, c, 1e300::DOUBLE AS shift FROM c_0
    UNION ALL
    SELECT step + 1, run, k, c, max(shift) OVER () FROM (
        SELECT step, run, k, new AS c, sum(list_distance(old, new)) OVER (PARTITION BY run) AS shift FROM (
            SELECT r.step, r.run, r.k, r.c AS old, coalesce(n.c, r.c) AS new
            FROM rounds r LEFT JOIN (
                SELECT run, k, list(x ORDER BY dim) AS c FROM (
                    SELECT run, k, dim, avg(x) AS x FROM (
                        SELECT run, k, unnest(v) AS x, generate_subscripts(v, 1) AS dim
                        FROM ({assigned("SELECT run, k, c FROM rounds WHERE shift > 0.1", points)}))
                    GROUP BY ALL) GROUP BY ALL) n USING (run, k)
            WHERE r.shift > 0.1)))"""


ROUNDS = rounds_from(POINTS)
LAST = "SELECT run, k, c FROM rounds WHERE step = (SELECT max(step) FROM rounds)"


def rounds() -> str:
    return f"""WITH RECURSIVE c_0 AS ({FIXED}), {ROUNDS}
        SELECT CAST(run AS INTEGER) AS run, CAST(k AS INTEGER) AS k, CAST(dim AS INTEGER) AS dim,
            {rounded("x")} AS value, true AS converged
        FROM (SELECT run, k, unnest(c) AS x, generate_subscripts(c, 1) AS dim FROM ({LAST}))"""


def whole_clustering() -> str:
    """Draws, then the rounds, then the cost of every run."""
    ctes = seed_chain()
    ctes.append(f"c_0 AS MATERIALIZED (SELECT run, place AS k, v AS c FROM picks JOIN ({POINTS}) USING (id))")
    ctes.append(ROUNDS)
    ctes.append(f"ended AS MATERIALIZED ({LAST})")
    ctes.append(f"""costs AS (SELECT run, sum(d2) AS cost
        FROM ({assigned("SELECT run, k, c FROM ended")}) GROUP BY 1)""")
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"""
        SELECT run, CAST(k AS INTEGER) AS k, CAST(dim AS INTEGER) AS dim, {rounded("x")} AS value,
            {rounded("cost", 4)} AS cost, true AS converged
        FROM (SELECT run, k, unnest(c) AS x, generate_subscripts(c, 1) AS dim FROM ended)
        JOIN costs USING (run)"""


def best_run(ctes: str, points: str) -> str:
    """Centres of the run of lowest cost after the rounds from the centres in c_0."""
    return f"""{ctes}, {rounds_from(points)},
        ended AS MATERIALIZED ({LAST}),
        costs AS (SELECT run, sum(d2) AS cost FROM ({assigned("SELECT run, k, c FROM ended", points)}) GROUP BY 1),
        best AS (SELECT run, cost FROM costs ORDER BY cost, run LIMIT 1)
        SELECT CAST(run AS INTEGER) AS run, CAST(k AS INTEGER) AS k, CAST(dim AS INTEGER) AS dim,
            {rounded("x")} AS value, {rounded("cost", 4)} AS cost
        FROM (SELECT run, k, unnest(c) AS x, generate_subscripts(c, 1) AS dim FROM ended) JOIN best USING (run)"""


def station_clusters() -> str:
    points = "SELECT vec_id, v FROM station_points"
    ctes = f"""{STATION_CTES.replace("WITH", "WITH RECURSIVE", 1)},
        station_points AS MATERIALIZED (SELECT station AS vec_id, [{", ".join(COEFFICIENTS)}] AS v,
            row_number() OVER (ORDER BY station) - 1 AS nr FROM wide
            WHERE {" AND ".join(f"{c} IS NOT NULL" for c in COEFFICIENTS)}),
        c_0 AS (SELECT nr // {STATION_K} AS run, nr % {STATION_K} AS k, v AS c FROM station_points
            WHERE nr < {STATION_RUNS * STATION_K})"""
    return best_run(ctes, points)


def stump(model: str) -> str:
    """Errors of the single split with the least impurity, which is the same by Gini and by variance."""
    values = "[l_quantity, l_discount, l_tax]"
    return f"""
        WITH r AS (SELECT {split_name(LINE_IDS, 0.7)} AS set, CAST(l_extendedprice > 40000 AS INTEGER) AS y,
            {values} AS x FROM lineitem),
        counts AS (SELECT f, v, sum(y) AS p, count(*) AS n FROM (
            SELECT unnest([1, 2, 3]) AS f, unnest(x) AS v, y FROM r WHERE set = 'train') GROUP BY f, v),
        below AS (SELECT f, v, lead(v) OVER w AS above, sum(p) OVER w AS pl, sum(n) OVER w AS nl,
            sum(p) OVER (PARTITION BY f) AS p, sum(n) OVER (PARTITION BY f) AS n
            FROM counts WINDOW w AS (PARTITION BY f ORDER BY v)),
        best AS (SELECT f, (v + above) / 2 AS t, pl / nl > 0.5 AS low, (p - pl) / (n - nl) > 0.5 AS high
            FROM below WHERE above IS NOT NULL
            ORDER BY pl * (nl - pl) / nl + (p - pl) * (n - nl - p + pl) / (n - nl) LIMIT 1)
        SELECT '{model}' AS model, 1 AS depth, set, count(*) AS n,
            {rounded("avg(CAST((CASE WHEN x[f] <= t THEN low ELSE high END) <> (y = 1) AS INTEGER))")} AS error
        FROM r, best GROUP BY set"""


def best_cut(cells: str) -> str:
    """Of each node the cut of least remaining variance of labels 1 and -1: node, f, t, gain, s, n."""
    return f"""
        SELECT node, f, t, s, n, 1 - (s / n) ** 2 - nl / n * (1 - (sl / nl) ** 2) - nr / n * (1 - (sr / nr) ** 2) AS gain
        FROM (SELECT node, c.f, t, sum(s) AS s, sum(n) AS n, sum(s) FILTER (WHERE v <= t) AS sl, sum(n) FILTER (WHERE v <= t) AS nl,
                sum(s) FILTER (WHERE v > t) AS sr, sum(n) FILTER (WHERE v > t) AS nr
            FROM {cells} c JOIN cuts ON c.f = cuts.f GROUP BY node, c.f, t)
        WHERE nl > 0 AND nr > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, t) = 1"""


def nodes() -> str:
    cells = """SELECT node, f, v, sum(y)::DOUBLE AS s, count(*) AS n FROM (
            SELECT node, y, unnest([1, 2, 3]) AS f, unnest(x) AS v FROM {}) GROUP BY ALL"""
    return f"""
        WITH r AS MATERIALIZED (SELECT 0 AS node, CASE WHEN l_extendedprice > 40000 THEN 1 ELSE -1 END AS y,
            [l_quantity, l_discount, l_tax] AS x FROM lineitem),
        cuts AS (SELECT f, (v + above) / 2 AS t FROM (
            SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS above FROM (
                SELECT DISTINCT f, v FROM (SELECT unnest([1, 2, 3]) AS f, unnest(x) AS v FROM r))) WHERE above IS NOT NULL),
        c1 AS ({cells.format("r")}), b1 AS MATERIALIZED ({best_cut("c1")}),
        r2 AS MATERIALIZED (SELECT CASE WHEN x[f] <= t THEN 1 ELSE 4 END AS node, y, x FROM r, b1),
        c2 AS ({cells.format("r2")}), b2 AS MATERIALIZED ({best_cut("c2")}),
        r3 AS (SELECT node + CASE WHEN x[f] <= t THEN 1 ELSE 2 END AS node, y FROM r2 JOIN b2 USING (node)),
        every AS (SELECT node, f - 1 AS feature, t, CASE node WHEN 0 THEN 1 ELSE node + 1 END AS l,
                CASE node WHEN 0 THEN 4 ELSE node + 2 END AS r, gain, s / n AS p, n FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2)
            UNION ALL SELECT node, NULL, NULL, NULL, NULL, NULL, avg(y), count(*) FROM r3 GROUP BY node)
        SELECT 0 AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, {rounded("t")} AS threshold,
            CAST(l AS INTEGER) AS "left", CAST(r AS INTEGER) AS "right", {rounded("gain", 9)} AS gain,
            {rounded("p", 9)} AS prediction, CAST(n AS BIGINT) AS n FROM every"""


def categorical_stump() -> str:
    lists = {c: "[" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in values) + "]" for c, values in CATEGORIES.items()}
    places = ", ".join(
        f"list_position({values}, {'month(l_shipdate)' if c == 'month' else c}) - 1" for c, values in lists.items()
    )
    return f"""
        WITH r AS (SELECT {split_name(LINE_IDS, 0.7)} AS set, CAST(l_quantity > 25 AS INTEGER) AS y, [{places}] AS x FROM lineitem),
        counts AS (SELECT f, v, sum(y) AS p, count(*) AS n FROM (
            SELECT unnest([1, 2, 3]) AS f, unnest(x) AS v, y FROM r WHERE set = 'train') GROUP BY f, v),
        below AS (SELECT f, v, row_number() OVER w AS pos, sum(p) OVER w AS pl, sum(n) OVER w AS nl,
            sum(p) OVER (PARTITION BY f) AS p, sum(n) OVER (PARTITION BY f) AS n
            FROM counts WINDOW w AS (PARTITION BY f ORDER BY p / n)),
        best AS (SELECT f, pos, pl / nl > 0.5 AS low, (p - pl) / (n - nl) > 0.5 AS high FROM below WHERE nl < n
            ORDER BY pl * (nl - pl) / nl + (p - pl) * (n - nl - p + pl) / (n - nl) LIMIT 1),
        chosen AS (SELECT best.f, list(v) AS subset, any_value(low) AS low, any_value(high) AS high
            FROM below JOIN best ON below.f = best.f AND below.pos <= best.pos GROUP BY best.f)
        SELECT 'boosted' AS model, 1 AS depth, set, count(*) AS n,
            {rounded("avg(CAST((CASE WHEN list_contains(subset, x[f]) THEN low ELSE high END) <> (y = 1) AS INTEGER))")} AS error
        FROM r, chosen GROUP BY set"""


COSTS = f"SELECT run, sum(d2) AS cost FROM ({assigned(FIXED)}) GROUP BY 1"
ENTROPY = f"""
    WITH a AS MATERIALIZED (SELECT vec_id, list(k ORDER BY run) AS sig FROM ({assigned(FIXED)}) GROUP BY 1),
    counts AS (SELECT runs, sig[1:runs] AS prefix, count(*) AS n
        FROM a CROSS JOIN range(1, {RUNS + 1}) r(runs) GROUP BY ALL)
    SELECT CAST(runs AS INTEGER) AS runs, {rounded("-sum(p * log2(p))")} AS entropy
    FROM (SELECT runs, n / sum(n) OVER (PARTITION BY runs) AS p FROM counts) GROUP BY 1"""

ORACLES: dict[str, str] = {
    "tree_stump_errors": stump("boosted"),
    "forest_stump_errors": stump("forest"),
    "tree_categorical_errors": categorical_stump(),
    "tree_nodes": nodes(),
    "message_job_top10": MESSAGE_JOB,
    **{f"ngram_top5_n{n}": ngram_top5(n) for n in range(1, 6)},
    "ngram_top5_all": NGRAM_ALL,
    "ngram5_punct_deleted_top100": f"SELECT count, ngram FROM ({ngrams(5, True)}) ORDER BY count DESC, ngram LIMIT 100",
    "ngram_counts_n2": ngrams(2),
    "json_valid_posts": POSTS,
    "json_distinct_users": f"SELECT count(DISTINCT user_id) AS n_users FROM ({POSTS})",
    "posts_per_group": f"SELECT {GROUP} AS group_id, count(*) AS n FROM events GROUP BY 1",
    "posts_right_outer": f"""SELECT CAST(user_id AS VARCHAR) AS user_id, {GROUP} AS group_id,
        event_type AS text, count(*) AS n FROM events GROUP BY ALL""",
    "tokens_extract": f"""SELECT conv_id, token, count(*) AS n
        FROM ({token_rows("conversations", "text", "conv_id,")}) GROUP BY ALL""",
    "tokens_rich": f"""SELECT conv_id, token, count(*) AS n
        FROM ({token_rows(RICH, "text", "conv_id,")}) GROUP BY ALL""",
    "tokens_markup": f"SELECT token, count(*) AS n FROM ({token_rows('pages', 'html')}) GROUP BY 1",
    "entities_decoded": f"SELECT page_id, {decoded('html')} AS decoded FROM pages",
    "text_escaped": ESCAPED,
    "token_users_total": TOTALS,
    "token_vocabulary": f"""SELECT count(*) AS tokens, count(*) FILTER (WHERE n_all >= {MIN_USERS})
        AS popular FROM ({TOTALS})""",
    "token_popular_top20": f"SELECT * FROM ({TOTALS}) WHERE n_all >= {MIN_USERS} ORDER BY n_all DESC, token LIMIT 20",
    "token_group_counts": GROUP_COUNTS,
    "token_relative_popularity_top10": RELATIVE,
    "class_distribution": SHARES,
    "class_distribution_named": NAMED_SHARES,
    "hash_sample_split": SAMPLE_SPLIT,
    "class_distribution_test_set": TEST_CLASSES,
    "profile_day_stats": f"""SELECT measurement, day, {rounded("mean")} AS mean, {rounded("var")} AS var,
        ne FROM ({PROFILE})""",
    "profile_band": BAND,
    "profile_missing_days": MISSING,
    "profile_scalars": STATS,
    "profile_histogram": HISTOGRAM,
    "statistics_store": STORED,
    "stored_band": BAND,
    "stored_components": LINE_COMPONENTS,
    "reader_paragraphs": "SELECT md5(text) AS digest, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "reader_manifest": f"SELECT user_id, count(*) AS n FROM ({POSTS}) GROUP BY 1",
    "reader_csv_report": CSV_REPORT,
    "nested_flatten": FLATTENED,
    "derived_measures": DERIVED,
    "station_selection": SELECTED,
    "covariance_matrix": f"SELECT measurement, i, j, n, {rounded('cov')} AS cov FROM ({covariance(True)})",
    "eigen_invariants": INVARIANTS,
    "full_rank_identity": IDENTITY,
    "components_lines": LINE_COMPONENTS,
    "reconstruction_lines": LINE_ERRORS,
    "extremes_lines": LINE_EXTREMES,
    "extremes_lines_series": LINE_SERIES,
    "station_coefficients": STATION_TABLE,
    "station_regression": station_regression(),
    "station_clusters": station_clusters(),
    "kmeans_best_centers": best_run(f"WITH RECURSIVE c_0 AS ({FIXED})", POINTS),
    "vector_contract": CONTRACT,
    "profile_sound_days": SOUND_DAYS,
    "reconstruction_fixed_basis": fixed_basis(),
    "regression_2f": two_features(),
    "regression_sensitivity": sensitivity(),
    "regression_coefficients": slopes(),
    "regression_predictions": PREDICTED,
    "kmeans_seed_d2": seeds(),
    "kmeans_lloyd_steps": rounds(),
    "kmeans_full": whole_clustering(),
    "kmeans_cost_by_run": f"SELECT CAST(run AS INTEGER) AS run, {rounded('cost', 4)} AS cost FROM ({COSTS})",
    "kmeans_cost_summary": f"""SELECT {rounded("log2(max(cost))")} AS log2_max,
        {rounded("log2(min(cost))")} AS log2_min, {rounded("log2(avg(cost))")} AS log2_mean,
        CAST(arg_min(run, {{'cost': cost, 'run': run}}) AS INTEGER) AS best_run FROM ({COSTS})""",
    "kmeans_assignment": f"""SELECT CAST(vec_id AS VARCHAR) AS id,
        string_agg(CAST(k AS VARCHAR), ',' ORDER BY run) AS assigned FROM ({assigned(FIXED)}) GROUP BY 1""",
    "kmeans_entropy": ENTROPY,
}
