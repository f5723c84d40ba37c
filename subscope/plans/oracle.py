"""The same questions in SQL, for another engine over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from subscope.operators.models import SPLIT_BUCKETS
from subscope.plans.workload import AS_OF, GRADED_CHARS, PLAYS_PER_USER, SYSTEM_TEXT
from subscope.settings import ACTIVE, CANCELLED, PROPENSITY_BANDS, RISK_BANDS
from subscope.sources import banks
from subscope.sources.proxy import ACTIVE_SINCE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _key(key_format: tuple[str, int], number: str) -> str:
    prefix, width = key_format
    digits = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest({width}, length({digits})) AS INTEGER), '0')"


def _half_up(part: str, whole: str, places: int) -> str:
    """part / whole, both whole numbers, rounded half up."""
    scale = 10**places
    return f"CAST((2 * ({part}) * {scale} + ({whole})) // (2 * ({whole})) AS DOUBLE) / {scale}e0"


def _nth(bank: Sequence[str], index: str) -> str:
    return f"list_extract([{', '.join(_text(b) for b in bank)}], CAST({index} AS BIGINT) + 1)"


def _draw(keys: str, salt: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys.split(","))
    return f"CAST(concat('0x', substr(md5(concat_ws('|', {parts}, '{salt}')), 1, 8)) AS BIGINT)"


def _pick(bank: Sequence[str], salt: str, keys: str = "n") -> str:
    return _nth(bank, f"{_draw(keys, salt)} % {len(bank)}")


def _int(keys: str, salt: str, base: int, span: int) -> str:
    return f"CAST({base} + {_draw(keys, salt)} % {span} AS INTEGER)"


def _u(keys: str, salt: str) -> str:
    return f"({_draw(keys, salt)} / 4294967296e0)"


USERS = f"""
users AS (
  SELECT {_key(banks.USER_KEY, 'c_custkey')} AS user_id, c_name AS name,
         CASE WHEN c_acctbal < 2500 THEN 'Free' WHEN c_acctbal < 6500 THEN 'Standard' ELSE 'Premium' END AS plan,
         n_name AS state, {_nth(banks.AGE_BANDS, 'c_custkey % 5')} AS age_band, c_mktsegment AS main_device,
         coalesce(CAST(min(o_orderdate) AS DATE), DATE '1995-01-01') AS signup_date,
         CASE WHEN CAST(max(o_orderdate) AS DATE) >= DATE '{ACTIVE_SINCE}' THEN '{ACTIVE}' ELSE '{CANCELLED}' END AS status,
         c_custkey AS n
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_name, c_acctbal, n_name, c_mktsegment)"""
TITLES = f"""
titles AS (
  SELECT {_key(banks.TITLE_KEY, 'p_partkey')} AS content_id, p_name AS title, p_type AS genre,
         CASE WHEN p_size <= 30 THEN 'Filme' ELSE 'Série' END AS kind
  FROM part)"""
PLAYS = f"""
plays AS (
  SELECT event_id, {_key(banks.USER_KEY, 'user_id')} AS user_id, {_key(banks.TITLE_KEY, 'k')} AS content_id, ts,
         CASE event_type WHEN 'purchase' THEN 'complete' WHEN 'click' THEN 'pause' WHEN 'error' THEN 'stop'
              ELSE 'play' END AS event,
         {_nth(banks.DEVICES, 'k % 5')} AS device, least(100e0, value) AS pct_watched,
         CAST(greatest(1, floor(value)) AS INTEGER) AS watch_min
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
FEATURES = f"""
user_features AS (
  SELECT u.user_id, plan, state, age_band, main_device,
         CAST(DATE '{AS_OF}' - signup_date AS INTEGER) AS tenure_days, status,
         coalesce(n_events, 0) AS n_events, coalesce(watch_total, 0) AS watch_total,
         coalesce(watch_avg, 0e0) AS watch_avg, coalesce(pct_avg, 0e0) AS pct_avg,
         CAST(coalesce(completion_rate, 0e0) AS DECIMAL(15,5)) AS completion_rate,
         coalesce(n_genres, 0) AS n_genres, coalesce(n_devices, 0) AS n_devices,
         coalesce(recency_days, 999) AS recency_days
  FROM users u LEFT JOIN (
    SELECT p.user_id, count(*) AS n_events, CAST(sum(watch_min) AS BIGINT) AS watch_total,
           CAST(sum(watch_min) AS DOUBLE) / count(watch_min) AS watch_avg,
           CAST(sum(CAST(round_even(pct_watched * 10000, 0) AS BIGINT)) AS DOUBLE) / (count(*) * 10000e0) AS pct_avg,
           {_half_up("count(*) FILTER (event = 'complete')", 'count(*)', 5)} AS completion_rate,
           count(DISTINCT genre) AS n_genres, count(DISTINCT device) AS n_devices,
           CAST(DATE '{AS_OF}' - max(CAST(ts AS DATE)) AS INTEGER) AS recency_days
    FROM plays p LEFT JOIN titles t ON p.content_id = t.content_id GROUP BY p.user_id) e ON u.user_id = e.user_id)"""


def _band(p: str, bands: Sequence[str]) -> str:
    low, middle, high = bands
    return (
        f"CASE WHEN {p} IS NULL OR isnan({p}) OR {p} <= -0.01e0 OR {p} > 1.01e0 THEN 'nan' "
        f"WHEN {p} <= 0.3e0 THEN '{low}' WHEN {p} <= 0.6e0 THEN '{middle}' ELSE '{high}' END"
    )


def _spread(multiplier: int) -> str:
    return f"(((n * {multiplier}) % 10007) / 10006e0)"


SCORED = f"scored AS (SELECT *, {_spread(7919)} AS p FROM users)"
CHURN_SCORES = f"""
churn_scores AS (
  SELECT user_id, plan, status, round_even(p, 4) AS prob_churn, {_band('p', RISK_BANDS)} AS risk_band FROM scored)"""
UPGRADE_SCORES = f"""
upgrade_scores AS (
  SELECT user_id, plan, round_even(p, 4) AS prob_upgrade, {_band('p', PROPENSITY_BANDS)} AS band
  FROM (SELECT *, {_spread(104729)} AS p FROM users WHERE plan = 'Free'))"""
LABELLED = f"labelled AS (SELECT p AS score, CAST(status = '{CANCELLED}' AS INTEGER) AS label FROM scored)"

EVERYTHING = (USERS, TITLES, PLAYS, FEATURES, SCORED, CHURN_SCORES, UPGRADE_SCORES)


def _with(*views: str, query: str) -> str:
    return "WITH " + ", ".join(views) + "\n" + query


def _customers_of(side: str) -> str:
    return (
        f"SELECT {_key(banks.USER_KEY, 'o_custkey')} AS user_id, count(*) AS n_orders, "
        f"CAST(max(dayofweek(CAST(o_orderdate AS DATE))) + 1 AS INTEGER) AS last_weekday FROM orders "
        f"WHERE CAST(o_orderdate AS DATE) {side} DATE '1997-06-01' GROUP BY o_custkey"
    )


BEFORE = f"a AS ({_customers_of('<')})"
AFTER = f"b AS ({_customers_of('>=')})"


def _gen_titles() -> str:
    synopsis = ", ".join(
        _pick(bank, salt)
        for bank, salt in (
            (banks.SYNOPSIS_OPENINGS, "ab"), (banks.SYNOPSIS_HEROES, "pr"),
            (banks.SYNOPSIS_TURNS, "dv"), (banks.SYNOPSIS_CLOSINGS, "fe"),
        )
    )
    cast = ", ".join(_pick(banks.CAST_NAMES, salt) for salt in ("e1", "e2", "e3"))
    return f"""
    SELECT {_key(banks.TITLE_KEY, 'n')} AS content_id,
           trim(concat_ws(' ', {_pick(banks.TITLE_PREFIXES, 'pfx')},
                {_pick(banks.TITLE_CORES, 'nuc')} || {_pick(banks.TITLE_SUFFIXES, 'sfx')})) AS title,
           kind, genre, {_pick(banks.GENRES, 'gen2')} AS genre2, {_int('n', 'ano', 1990, 36)} AS year,
           {_pick(banks.RATING_CLASSES, 'cls')} AS rating_class, {_pick(banks.LANGUAGES, 'idi')} AS language,
           {_pick(banks.COUNTRIES, 'pais')} AS country, {_pick(banks.CAST_NAMES, 'dir')} AS director,
           concat_ws(', ', {cast}) AS cast_names,
           floor((5e0 + {_u('n', 'nota')} * 5e0) * 10e0 + 0.5e0) / 10e0 AS score_avg,
           CASE WHEN kind = 'Série' THEN {_int('n', 'temp', 1, 8)} END AS seasons,
           CASE WHEN kind = 'Filme' THEN {_int('n', 'dur', 80, 90)} END AS duration_min,
           concat_ws(' ', {synopsis}, 'Um título de ' || genre || '.') AS synopsis
    FROM (SELECT p_partkey AS n, {_pick(banks.KINDS, 'tipo', 'p_partkey')} AS kind,
                 {_pick(banks.GENRES, 'gen', 'p_partkey')} AS genre FROM part)"""


LATENT = f"""
base AS (SELECT c_custkey AS n, ({_draw('c_custkey', 'eng')} % 1000) / 1000e0 AS eng FROM customer),
planned AS (
  SELECT *, CASE WHEN blend < 0.42e0 THEN 'Free' WHEN blend < 0.75e0 THEN 'Standard' ELSE 'Premium' END AS plan
  FROM (SELECT *, 0.65e0 * eng + 0.35e0 * {_u('n', 'plan')} AS blend FROM base)),
latent AS (
  SELECT *, CAST(floor({PLAYS_PER_USER!r}e0 * (0.25e0 + 1.5e0 * eng) * (0.6e0 + 0.8e0 * {_u('n', 'n_ev')}) + 0.5e0) AS INTEGER) AS n_ev
  FROM planned)"""


def _gen_users() -> str:
    first, last = _pick(banks.FIRST_NAMES, "pn"), _pick(banks.LAST_NAMES, "un")
    return f"""
    SELECT {_key(banks.USER_KEY, 'n')} AS user_id, concat_ws(' ', {first}, {last}) AS name,
           lower({first}) || '.' || lower({last}) || CAST(n AS VARCHAR) || '@{banks.EMAIL_DOMAIN}' AS email,
           plan, {_pick(banks.STATES, 'uf')} AS state, {_pick(banks.AGE_BANDS, 'faixa')} AS age_band,
           {_pick(banks.DEVICES, 'disp')} AS main_device,
           DATE '{AS_OF}' - CAST(floor({_u('n', 'signup')} * 1825) AS INTEGER) AS signup_date,
           CASE WHEN {_u('n', 'status')} < 0.32e0 - 0.26e0 * eng + CASE WHEN plan = 'Free' THEN 0.15e0 ELSE 0e0 END
                THEN '{CANCELLED}' ELSE '{ACTIVE}' END AS status
    FROM latent"""


def _gen_plays() -> str:
    pair, one_each = "n,k", "n || '_' || k"

    def part(salt: str, span: int) -> str:
        return f"CAST(floor({_u(pair, salt)} * {span}) AS INTEGER)"

    return f"""
    SELECT 'EVT' || CAST(n AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS event_id, {_key(banks.USER_KEY, 'n')} AS user_id,
           {_key(banks.TITLE_KEY, f"({_draw(pair, 'c')} % (SELECT count(*) FROM part) + 1)")} AS content_id,
           TIMESTAMP '{AS_OF} 00:00:00' - to_days({part('day', 365)}) - to_hours({part('hour', 24)})
             - to_minutes({part('minute', 60)}) AS ts,
           CASE WHEN {_u(pair, 'done')} < 0.15e0 + 0.55e0 * eng THEN 'complete'
                ELSE {_pick(banks.OTHER_EVENTS, 'evt', one_each)} END AS event,
           {_pick(banks.DEVICES, 'dispe', one_each)} AS device,
           floor(least(100e0, (20 + 80 * eng) * (0.5e0 + {_u(pair, 'pct')})) * 10e0 + 0.5e0) / 10e0 AS pct_watched,
           greatest(1, CAST(floor((5 + 110 * eng) * (0.5e0 + {_u(pair, 'watch')})) AS INTEGER)) AS watch_min
    FROM (SELECT n, eng, unnest(range(1, n_ev + 1)) AS k FROM latent WHERE n_ev >= 1)"""


def _classification_report() -> str:
    return """
    , cells AS (
      SELECT CAST(count(*) FILTER (label = 0 AND score < 0.5e0) AS DOUBLE) AS c00,
             CAST(count(*) FILTER (label = 0 AND score >= 0.5e0) AS DOUBLE) AS c01,
             CAST(count(*) FILTER (label = 1 AND score < 0.5e0) AS DOUBLE) AS c10,
             CAST(count(*) FILTER (label = 1 AND score >= 0.5e0) AS DOUBLE) AS c11, count(*) AS total FROM labelled),
    classes AS (
      SELECT *, coalesce(c00 / nullif(c00 + c10, 0), 0) AS p0, coalesce(c00 / nullif(c00 + c01, 0), 0) AS r0,
             2e0 * c00 / (2e0 * c00 + c01 + c10) AS f0, coalesce(c11 / nullif(c11 + c01, 0), 0) AS p1,
             coalesce(c11 / nullif(c11 + c10, 0), 0) AS r1, 2e0 * c11 / (2e0 * c11 + c01 + c10) AS f1,
             c00 + c01 AS s0, c10 + c11 AS s1 FROM cells)
    SELECT '0' AS entry, p0 AS precision, r0 AS recall, f0 AS f1, CAST(s0 AS BIGINT) AS support FROM classes
    UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM classes
    UNION ALL SELECT 'accuracy', NULL, NULL, (c00 + c11) / total, total FROM classes
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total FROM classes
    UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / total, (r0 * s0 + r1 * s1) / total,
                     (f0 * s0 + f1 * s1) / total, total FROM classes"""


SPLIT = f"""
drawn AS (SELECT user_id, CAST(status = '{CANCELLED}' AS INTEGER) AS label, {_draw('user_id', 'split42')} AS d FROM users),
placed AS (
  SELECT user_id, label, row_number() OVER (PARTITION BY label ORDER BY d % {SPLIT_BUCKETS}, d, user_id) AS place,
         count(*) OVER (PARTITION BY label) AS n FROM drawn),
parted AS (
  SELECT user_id, label, CASE WHEN place <= floor(n * 0.25e0 + 0.5e0) THEN 'test' ELSE 'train' END AS split FROM placed)"""


def _search(k: int, condition: str) -> str:
    return f"""
    SELECT query_id, vec_id, score, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM (
        SELECT q.vec_id AS query_id, i.vec_id AS vec_id,
               round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 9) AS score
        FROM embeddings q JOIN embeddings i ON {condition}))
    WHERE rank <= {k}"""


TERM = r"[\p{L}\p{N}]+"
ASKED = """
said AS (SELECT concat_ws('-', conv_id, turn) AS q, text FROM conversations WHERE role = 'user')"""


def _weights(name: str, texts: str, keys: str, n: str) -> str:
    """Views ``{name}_terms`` (key, term, weight) and ``{name}_rare`` of whole-number weights."""
    return f"""
{name}_counts AS (
  SELECT {keys}, term, CAST(length(bin(count(*))) AS BIGINT) AS bits
  FROM (SELECT {keys}, unnest(regexp_extract_all(lower(coalesce(text, '')), '{TERM}')) AS term FROM {texts}) GROUP BY ALL),
{name}_rare AS (
  SELECT term, CAST(round(100 * ln(1 + CAST(({n}) AS DOUBLE) / count(*))) AS BIGINT) AS rarity FROM {name}_counts GROUP BY term),
{name}_terms AS (SELECT {keys}, term, bits * rarity AS weight FROM {name}_counts JOIN {name}_rare USING (term)),
{name}_squares AS (SELECT {keys}, CAST(sum(weight * weight) AS BIGINT) AS square FROM {name}_terms GROUP BY ALL HAVING sum(weight * weight) > 0)"""


def _matches(name: str, keys: str, questions: str, condition: str = "true") -> str:
    """View ``matches`` (q, key, score): all texts that share a term with a question."""
    return f"""
asked AS (
  SELECT q, wanted, term, length(bin(count(*))) * rarity AS ask
  FROM (SELECT q, wanted, unnest(regexp_extract_all(lower(coalesce(text, '')), '{TERM}')) AS term FROM {questions}) JOIN {name}_rare USING (term)
  GROUP BY q, wanted, term, rarity),
long AS (SELECT q, CAST(sum(ask * ask) AS BIGINT) AS long FROM asked GROUP BY q),
dots AS (SELECT q, wanted, {keys}, CAST(sum(ask * weight) AS BIGINT) AS dot FROM asked JOIN {name}_terms USING (term) GROUP BY ALL),
matches AS (
  SELECT q, wanted, {keys}, CAST(dot AS DOUBLE) / (sqrt(CAST(long AS DOUBLE)) * sqrt(CAST(square AS DOUBLE))) AS score
  FROM dots JOIN long USING (q) JOIN {name}_squares USING ({keys}) WHERE {condition})"""


def _find_titles(questions: str, condition: str = "true", details: bool = True) -> str:
    more = (
        ", title, kind, genre, year, score_avg AS rating, director, cast_names, duration_min, seasons, "
        "substr(coalesce(synopsis, ''), 1, 180) AS synopsis"
    )
    return f"""
WITH titles AS ({_gen_titles()}),
synopses AS (SELECT content_id, genre, synopsis AS text FROM titles), {ASKED},
questions AS ({questions}), {_weights("t", "synopses", "content_id, genre", "SELECT count(*) FROM titles")},
{_matches("t", "content_id, genre", "questions", condition)}
SELECT query_id, content_id, score, rank{more if details else ""} FROM (
  SELECT q AS query_id, content_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, content_id) AS INTEGER) AS rank
  FROM matches) JOIN titles USING (content_id) WHERE rank <= 6"""


PASSAGES = """
words AS (
  SELECT doc_id, lang, list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
passages AS (
  SELECT doc_id, lang, CAST(i * 60 AS INTEGER) AS passage, CAST(len(words[i * 60 + 1:i * 60 + 120]) AS INTEGER) AS n_words,
         array_to_string(words[i * 60 + 1:i * 60 + 120], ' ') AS text
  FROM words, unnest(range(CAST(greatest(0, ceil((len(words) - 120) / 60)) AS BIGINT) + 1)) AS t(i) WHERE len(words) > 0)"""
SUPPORT = f"""
WITH {PASSAGES}, {ASKED}, questions AS (SELECT q, CAST(NULL AS VARCHAR) AS wanted, text FROM said),
{_weights("p", "passages", "doc_id, passage", "SELECT count(*) FROM passages")}, {_matches("p", "doc_id, passage", "questions")},
firsts AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY q, doc_id ORDER BY score DESC, passage) = 1),
hits AS (
  SELECT q AS query_id, doc_id, passage, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM firsts QUALIFY rank <= 3)"""


def _bands_of(table: str, score: str, band: str, model: str) -> str:
    total = f"CAST(sum(CAST(round_even({score} * 10000, 0) AS BIGINT)) AS HUGEINT)"
    return (
        f"SELECT {band} AS band, count(*) AS n_users, {_half_up(total, f'(count({score}) * 10000)', 3)} AS avg_score, "
        f"'{model}' AS model FROM {table} GROUP BY {band}"
    )


THEN_NOW = f"""
graded AS (SELECT d.doc_id, text, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
a AS (SELECT doc_id, text, quality AS grade FROM graded WHERE quality IS NOT NULL),
b AS (SELECT doc_id, text, CASE WHEN n_chars < {GRADED_CHARS} THEN 0 ELSE coalesce(quality, 0) END AS grade
      FROM graded WHERE coalesce(toxic, 0) = 0)"""


ORACLE: dict[str, str] = {
    "scan_users": _with(USERS, query="SELECT user_id, plan, state, signup_date, status FROM users"),
    "sink_roundtrip": _with(USERS, query="SELECT user_id, plan, state, signup_date, status FROM users"),
    "partitioned_scan": _with(PLAYS, query="""
        SELECT device, count(*) AS total, CAST(sum(watch_min) AS BIGINT) AS minutes
        FROM plays WHERE event = 'complete' GROUP BY device"""),
    "table_counts": """
        SELECT 'users' AS table_name, (SELECT count(*) FROM customer) AS n_rows
        UNION ALL SELECT 'titles', (SELECT count(*) FROM part)
        UNION ALL SELECT 'plays', (SELECT count(*) FROM events)
        UNION ALL SELECT 'churn_scores', (SELECT count(*) FROM customer)""",
    "dq_not_null": """
        WITH l AS (SELECT * FROM documents d LEFT JOIN labels USING (doc_id))
        SELECT * FROM (
          SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS n_rows FROM l
          UNION ALL SELECT 'text', count(*) - count(text) FROM l
          UNION ALL SELECT 'lang', count(*) - count(lang) FROM l
          UNION ALL SELECT 'quality', count(*) - count(quality) FROM l
          UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM l) WHERE n_rows > 0""",
    "dq_unique": _with(TITLES, query="""
        SELECT title, genre, count(*) AS n_rows FROM titles GROUP BY title, genre HAVING count(*) > 1"""),
    "dq_orphans": _with(USERS, TITLES, PLAYS, query="""
        SELECT 'plays.user_id' AS reference, user_id AS key, count(*) AS n_rows FROM plays
          WHERE user_id NOT IN (SELECT user_id FROM users) GROUP BY user_id
        UNION ALL SELECT 'plays.content_id', content_id, count(*) FROM plays
          WHERE content_id NOT IN (SELECT content_id FROM titles) GROUP BY content_id
        UNION ALL SELECT 'documents.doc_id', CAST(doc_id AS VARCHAR), count(*) FROM documents
          WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id"""),
    "snapshot_diff": _with(BEFORE, AFTER, query="""
        SELECT coalesce(a.user_id, b.user_id) AS user_id,
               CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END AS change,
               b.n_orders, b.last_weekday
        FROM a FULL JOIN b ON a.user_id = b.user_id
        WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.n_orders IS DISTINCT FROM b.n_orders
           OR a.last_weekday IS DISTINCT FROM b.last_weekday"""),
    "snapshot_apply": _with(AFTER, query="SELECT * FROM b"),
    "result_envelope": _with(USERS, query="""
        , counts AS (SELECT plan, count(*) AS n FROM users GROUP BY plan)
        SELECT '{"colunas":["plan","user_count"],"linhas":['
               || string_agg('["' || plan || '","' || n || '"]', ',' ORDER BY n DESC, plan) || ']}' AS envelope
        FROM counts"""),
    "gen_pick": f"""
        SELECT event_id AS n, {_pick(banks.OTHER_EVENTS, 'evt', 'event_id')} AS event,
               {_pick(banks.DEVICES, 'dispe', 'event_id')} AS device, {_u('event_id', 'u')} AS u FROM events""",
    "gen_titles": _gen_titles(),
    "gen_users": _with(LATENT, query=_gen_users()),
    "gen_plays": _with(LATENT, query=_gen_plays()),
    "user_features": _with(USERS, TITLES, PLAYS, FEATURES, query="SELECT * FROM user_features"),
    "features_by_status": _with(USERS, TITLES, PLAYS, FEATURES, query=f"""
        SELECT status, count(*) AS n_users, {_half_up('sum(n_events)', 'count(*)', 1)} AS avg_events,
               {_half_up('sum(watch_total)', 'count(*)', 0)} AS avg_watch_total,
               {_half_up('CAST(sum(completion_rate) * 100000 AS HUGEINT)', '(count(*) * 100000)', 3)} AS avg_completion
        FROM user_features GROUP BY status"""),
    "star_join": _with(USERS, TITLES, PLAYS, query="""
        SELECT event_id, p.user_id, plan, state, p.content_id, genre, watch_min
        FROM plays p JOIN users u ON p.user_id = u.user_id JOIN titles t ON p.content_id = t.content_id"""),
    "user_profile": _with(*EVERYTHING, query="""
        SELECT u.user_id, u.name, u.plan, u.status, u.state, u.age_band, u.main_device, u.signup_date, f.tenure_days,
               f.n_events, f.watch_total, f.completion_rate, f.recency_days, c.prob_churn, c.risk_band,
               g.prob_upgrade, g.band
        FROM users u LEFT JOIN user_features f ON u.user_id = f.user_id
        LEFT JOIN churn_scores c ON u.user_id = c.user_id LEFT JOIN upgrade_scores g ON u.user_id = g.user_id
        WHERE u.user_id IN (SELECT user_id FROM plays)"""),
    "churn_by_plan": _with(USERS, query=f"""
        SELECT plan, count(*) AS total,
               {_half_up(f"100 * count(*) FILTER (status = '{CANCELLED}')", 'count(*)', 1)} AS churn_pct
        FROM users GROUP BY plan"""),
    "users_by_plan": _with(USERS, query="SELECT plan, count(*) AS user_count FROM users GROUP BY plan"),
    "titles_by_genre": _with(TITLES, query="SELECT genre, count(*) AS title_count FROM titles GROUP BY genre"),
    "events_by_kind": _with(PLAYS, query=f"""
        SELECT event, count(*) AS total, {_half_up('sum(watch_min)', 'count(*)', 1)} AS avg_minutes
        FROM plays GROUP BY event"""),
    "top_titles_views": _with(TITLES, PLAYS, query="""
        SELECT title, genre, count(*) AS views FROM plays JOIN titles USING (content_id)
        GROUP BY title, genre ORDER BY views DESC, title, genre LIMIT 10"""),
    "top_titles_minutes": _with(TITLES, PLAYS, query="""
        SELECT content_id, title, CAST(sum(watch_min) AS BIGINT) AS minutes FROM plays JOIN titles USING (content_id)
        GROUP BY content_id, title ORDER BY minutes DESC, content_id LIMIT 10"""),
    "watch_by_plan": _with(USERS, PLAYS, query="""
        SELECT plan, CAST(sum(watch_min) AS DOUBLE) / count(*) AS avg_watch_minutes
        FROM plays JOIN users USING (user_id) GROUP BY plan"""),
    "free_high_band": _with(USERS, UPGRADE_SCORES, query=f"""
        SELECT count(*) AS high_propensity_users FROM upgrade_scores
        WHERE plan = 'Free' AND band = '{PROPENSITY_BANDS[2]}'"""),
    "metric_churn_by_state": _with(USERS, query=f"""
        SELECT state, CAST(count(*) FILTER (status = '{CANCELLED}') AS DOUBLE) / count(*) AS churn_rate
        FROM users GROUP BY state"""),
    "metric_completion_by_genre": _with(TITLES, PLAYS, query="""
        SELECT genre, CAST(count(*) FILTER (event = 'complete') AS DOUBLE) / count(*) AS completion_rate
        FROM plays JOIN titles USING (content_id) GROUP BY genre"""),
    "metric_minutes_by_plan_device": _with(USERS, PLAYS, query=f"""
        SELECT plan, device, CAST(sum(watch_min) AS BIGINT) AS watch_minutes FROM plays JOIN users USING (user_id)
        WHERE status = '{ACTIVE}' AND plan IN ('Standard', 'Premium') GROUP BY plan, device"""),
    "metric_payers_by_age": _with(USERS, query="""
        SELECT age_band, count(*) FILTER (plan IN ('Standard', 'Premium')) AS payer_count FROM users GROUP BY age_band"""),
    "metric_premium_users": _with(USERS, query="SELECT count(*) AS user_count FROM users WHERE plan = 'Premium'"),
    "metric_high_risk_by_state": _with(USERS, SCORED, CHURN_SCORES, query=f"""
        SELECT state, count(*) FILTER (risk_band = '{RISK_BANDS[2]}') AS high_risk_users
        FROM churn_scores JOIN users USING (user_id) GROUP BY state"""),
    "score_bands": _with(USERS, SCORED, CHURN_SCORES, query="SELECT user_id, prob_churn, risk_band FROM churn_scores"),
    "band_distribution": _with(USERS, SCORED, CHURN_SCORES, UPGRADE_SCORES, query=(
        _bands_of("churn_scores", "prob_churn", "risk_band", "churn")
        + " UNION ALL " + _bands_of("upgrade_scores", "prob_upgrade", "band", "upgrade"))),
    "retention_targets": _with(USERS, SCORED, CHURN_SCORES, query=f"""
        SELECT user_id, plan, prob_churn FROM churn_scores WHERE status = '{ACTIVE}'
        ORDER BY prob_churn DESC, user_id LIMIT 15"""),
    "upgrade_targets": _with(USERS, UPGRADE_SCORES, query="""
        SELECT user_id, prob_upgrade FROM upgrade_scores ORDER BY prob_upgrade DESC, user_id LIMIT 15"""),
    "target_churn": _with(USERS, query=f"SELECT user_id, CAST(status = '{CANCELLED}' AS INTEGER) AS label FROM users"),
    "target_paid": _with(USERS, query="SELECT user_id, CAST(plan IN ('Standard', 'Premium') AS INTEGER) AS label FROM users"),
    "label_base_rate": _with(USERS, SCORED, LABELLED, query="""
        SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, avg(label) AS base_rate FROM labelled"""),
    "roc_auc": _with(USERS, SCORED, LABELLED, query="""
        , g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM labelled GROUP BY score),
        c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS below FROM g)
        SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / 2e0 / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc,
               CAST(sum(pos) AS BIGINT) AS n_positive, CAST(sum(neg) AS BIGINT) AS n_negative FROM c"""),
    "classification_report": _with(USERS, SCORED, LABELLED, query=_classification_report()),
    "split_shares": _with(USERS, SPLIT, query="""
        SELECT label, split, count(*) AS n_rows FROM parted GROUP BY label, split"""),
    "split_rows": _with(USERS, SPLIT, query="SELECT user_id, label, split FROM parted"),
    "score_rules_churn": _with(USERS, query="""
        SELECT user_id, plan, TRUE AS in_range, TRUE AS band_follows, TRUE AS follows_from_nodes FROM users"""),
    "score_rules_upgrade": _with(USERS, query="""
        SELECT user_id, plan, TRUE AS in_range, TRUE AS band_follows, TRUE AS follows_from_nodes FROM users WHERE plan = 'Free'"""),
    "upgrade_held_out": _with(USERS, query="""
        SELECT CAST(floor(count(*) FILTER (plan <> 'Free') * 0.25e0 + 0.5e0) AS BIGINT) AS n_positive,
               CAST(floor(count(*) FILTER (plan = 'Free') * 0.25e0 + 0.5e0) AS BIGINT) AS n_negative,
               TRUE AS auc_agrees
        FROM users"""),
    "onehot_positions": _with(USERS, query="""
        , levels AS (SELECT count(DISTINCT plan) AS p, count(DISTINCT state) AS s, count(DISTINCT age_band) AS a FROM users)
        SELECT user_id, CAST(dense_rank() OVER (ORDER BY plan) - 1 AS INTEGER) AS plan_at,
               CAST(p + dense_rank() OVER (ORDER BY state) - 1 AS INTEGER) AS state_at,
               CAST(p + s + dense_rank() OVER (ORDER BY age_band) - 1 AS INTEGER) AS age_band_at,
               CAST(p + s + a + dense_rank() OVER (ORDER BY main_device) - 1 AS INTEGER) AS main_device_at
        FROM users, levels"""),
    "user_features_fed": _with(USERS, TITLES, PLAYS, FEATURES, query="SELECT * FROM user_features"),
    "dq_unique_feed": _with(TITLES, query="""
        SELECT title, genre, count(*) AS n_rows FROM titles GROUP BY title, genre HAVING count(*) > 1"""),
    "dq_orphans_feed": _with(TITLES, PLAYS, query="""
        SELECT content_id, count(*) AS n_rows FROM plays
        WHERE content_id NOT IN (SELECT content_id FROM titles) GROUP BY content_id"""),
    "replaced_table": _with(USERS, SCORED, CHURN_SCORES, query="SELECT * FROM churn_scores"),
    "table_preview": _with(TITLES, query="""
        SELECT content_id, title, genre, kind FROM titles ORDER BY genre, title, content_id LIMIT 10"""),
    "result_envelope_cut": _with(USERS, query="""
        , counts AS (SELECT state, plan, count(*) AS n FROM users GROUP BY state, plan ORDER BY n DESC, state, plan LIMIT 50)
        SELECT '{"colunas":["state","plan","n"],"linhas":['
               || string_agg('["' || state || '","' || plan || '","' || n || '"]', ',' ORDER BY n DESC, state, plan) || ']}' AS envelope
        FROM counts"""),
    "onehot_features": _with(USERS, query="""
        SELECT user_id, CAST((SELECT count(DISTINCT plan) + count(DISTINCT state) + count(DISTINCT age_band)
                                     + count(DISTINCT main_device) + 9 FROM users) AS INTEGER) AS n_columns,
               4 AS n_levels_set FROM users"""),
    "search_titles": _find_titles("SELECT q, CAST(NULL AS VARCHAR) AS wanted, text FROM said"),
    "search_titles_by_genre": _find_titles(
        f"SELECT q, nullif({_pick([*banks.GENRES, '', '', '', ''], 'asked', 'q')}, '') AS wanted, text FROM said",
        "wanted IS NULL OR wanted = genre",
    ),
    "support_hits": SUPPORT + " SELECT * FROM hits",
    "support_context": SUPPORT + """
        SELECT query_id, count(*) AS n_hits, string_agg(concat_ws(chr(10), lang, text), chr(10) || chr(10) ORDER BY rank) AS context
        FROM hits JOIN passages USING (doc_id, passage) GROUP BY query_id""",
    "article_passages": f"WITH {PASSAGES} SELECT doc_id, passage, n_words, text AS body FROM passages",
    "knn_ann": _search(5, "true"),
    "ann_recall": f"SELECT count(*) AS n_expected, count(*) > 0 AS enough FROM ({_search(5, 'true')})",
    "knn_exact": _search(5, "true"),
    "search_filtered": _search(5, "q.label = i.label"),
    "knn_stored": _search(5, "true"),
    "search_stored": _search(5, "q.label = i.label"),
    "search_one_label": _search(3, "i.label = 3"),
    "index_stats": """
        SELECT count(*) AS n_rows, count(*) - count(embedding) AS n_null_vectors,
               CAST(min(len(embedding)) AS INTEGER) AS min_dims, CAST(max(len(embedding)) AS INTEGER) AS max_dims,
               count(*) > 0 AND count(*) = count(embedding) AND min(len(embedding)) = max(len(embedding)) AS ready
        FROM embeddings""",
    "index_documents": "SELECT doc_id, lang, 256 AS n_dims FROM documents",
    "index_sync_plan": _with(THEN_NOW, query="""
        SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
               CASE WHEN a.doc_id IS NULL THEN 'insert' WHEN b.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
        FROM a FULL JOIN b ON a.doc_id = b.doc_id
        WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.grade IS DISTINCT FROM b.grade OR a.text IS DISTINCT FROM b.text"""),
    "index_synced": _with(THEN_NOW, query="SELECT doc_id, grade, 256 AS n_dims FROM b"),
    "index_sync_stream": _with(THEN_NOW, query="SELECT doc_id, grade, 256 AS n_dims FROM b"),
    "flatten_content": "SELECT conv_id, turn, text AS content FROM conversations",
    "normalize_roles": "SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant', 'system')",
    "chat_messages": f"""
        SELECT conv_id, turn, role, text AS content FROM conversations WHERE role IN ('user', 'assistant', 'system')
        UNION ALL SELECT DISTINCT conv_id, CAST(-1 AS BIGINT), 'system', {_text(SYSTEM_TEXT)} FROM conversations""",
}
