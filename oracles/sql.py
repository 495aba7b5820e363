"""Oracle SQL, generated from a few shared pieces.

The mails are derived from the tables by rule, never by parsing text, so the
oracles do not depend on the parser. Loops of fixed depth are unrolled.
"""

from __future__ import annotations

FEATURES = [
    "recvCount", "outDegree", "inDegree", "nightRatio",
    "sendRecvRatio", "activeMonths", "avgSentPerMonth",
]

MAIL = """
line AS (
  SELECT l_orderkey AS k, l_linenumber AS line,
         l_partkey AS person, l_returnflag = 'R' AS cc
  FROM lineitem),
gate AS (SELECT k, bool_or(NOT cc) AS has_to FROM line GROUP BY k),
dated AS (
  SELECT o_orderkey AS k, o_custkey AS cust,
         o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS sent,
         coalesce(has_to, false) AS has_to
  FROM orders LEFT JOIN gate ON gate.k = o_orderkey),
mail AS MATERIALIZED (
  SELECT k, cust, sent, 'p' || cust || '@en.example.com' AS src,
         'mail/' || k || '.' AS msg_id,
         CASE WHEN k % 97 <> 0 AND year(sent) BETWEEN 1998 AND 2002
              THEN strftime(sent, '%Y-%m') ELSE 'NA' END AS ym,
         CAST(k % 24 AS INTEGER) AS hour,
         CASE WHEN NOT has_to THEN 'no_recipient_field'
              WHEN k % 101 = 0 THEN 'invalid_sender' END AS skip_reason
  FROM dated),
edge AS MATERIALIZED (
  SELECT msg_id, src, 'p' || person || '@en.example.com' AS dst,
         CASE WHEN cc THEN 'cc' ELSE 'to' END AS type, ym, hour
  FROM mail JOIN line USING (k)
  WHERE skip_reason IS NULL AND person % 50 <> 0 AND person <> cust)"""

TOKEN = """
token AS (
  SELECT k, line, cc, person, 'p' || person || '@en.example.com' AS plain,
         CASE WHEN person % 50 = 0 THEN 'department: part ' || person
              WHEN line % 3 = 1 THEN upper('p' || person || '@en.example.com')
              WHEN line % 3 = 2
                THEN 'Person ' || person || ' <p' || person || '@en.example.com>'
              ELSE 'p' || person || '@en.example.com' END AS token
  FROM line)"""

FIELDS = (
    TOKEN
    + """,
joined AS (
  SELECT k, CASE WHEN k % 5 = 2 THEN '; ' ELSE ', ' END AS mark,
         replace(string_agg(token, chr(1) ORDER BY line, token) FILTER (NOT cc), chr(1), mark)
           AS to_list,
         replace(string_agg(token, chr(1) ORDER BY line, token) FILTER (cc), chr(1), mark)
           AS cc_list
  FROM token GROUP BY k),
zoned AS (
  SELECT *, sent + [0, -420, 330, 60, -300, -300, 120][k % 7 + 1] * INTERVAL 1 MINUTE AS there,
         ['+0000 (UTC)', '-0700 (PDT)', '+0530', 'CET', 'GMT-05:00', 'EST', '+0200 (CEST)']
           [k % 7 + 1] AS zone
  FROM mail),
field AS (
  SELECT zoned.*, to_list, cc_list, mark,
         CASE WHEN k % 101 = 0 THEN 'system' ELSE src END AS from_text,
         strftime(there, '%a, %-d %b ')
           || CASE WHEN k % 97 = 0 THEN '0001' ELSE strftime(there, '%Y') END
           || strftime(there, ' %H:%M:%S ') || zone AS date_text
  FROM zoned LEFT JOIN joined USING (k))"""
)

QUARTER = "substr(ym, 1, 4) || '-Q' || ((CAST(substr(ym, 6, 2) AS INTEGER) + 2) // 3)"

FEATURE = f"""
person AS (
  SELECT src AS email FROM mail WHERE skip_reason IS NULL
  UNION SELECT dst FROM edge),
sender AS (
  SELECT src AS email, count(*) AS sent, count(DISTINCT dst) AS outd,
         count(*) FILTER (hour < 6) AS night FROM edge GROUP BY src),
recipient AS (
  SELECT dst AS email, count(*) AS recv, count(DISTINCT src) AS ind FROM edge GROUP BY dst),
month AS (
  SELECT src AS email, count(DISTINCT ym) AS months FROM mail
  WHERE skip_reason IS NULL AND ym <> 'NA' GROUP BY src),
counts AS MATERIALIZED (
  SELECT email, coalesce(sent, 0) AS sent, coalesce(recv, 0) AS recv,
         coalesce(outd, 0) AS out_degree, coalesce(ind, 0) AS in_degree,
         coalesce(night, 0) AS night, coalesce(months, 0) AS months
  FROM person LEFT JOIN sender USING (email) LEFT JOIN recipient USING (email)
       LEFT JOIN month USING (email)),
feature AS MATERIALIZED (
  SELECT email, recv AS "recvCount", out_degree AS "outDegree", in_degree AS "inDegree",
         CASE WHEN sent > 0 THEN night::DOUBLE / sent ELSE 0.0 END::DOUBLE AS "nightRatio",
         CASE WHEN sent + recv > 0 THEN sent::DOUBLE / (sent + recv) ELSE 0.0 END::DOUBLE
           AS "sendRecvRatio",
         months AS "activeMonths",
         CASE WHEN months > 0 THEN sent::DOUBLE / months ELSE 0.0 END::DOUBLE
           AS "avgSentPerMonth"
  FROM counts)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# ---- PageRank ---------------------------------------------------------------

SIMPLE = "SELECT DISTINCT 0 AS grp, src, dst, 1.0::DOUBLE AS w FROM edge"
SIMPLE_QUARTERLY = (
    f"SELECT DISTINCT {QUARTER} AS grp, src, dst, 1.0::DOUBLE AS w FROM edge WHERE ym <> 'NA'"
)
RAW = "sum(CASE WHEN type = 'cc' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)"
FREQ = f"SELECT 0 AS grp, src, dst, {RAW} AS w FROM edge GROUP BY src, dst"
LOG = f"SELECT 0 AS grp, src, dst, 1 + ln(1 + {RAW}) AS w FROM edge GROUP BY src, dst"


def pagerank(graph: str, prefix: str = "", iterations: int = 10) -> str:
    """CTEs whose last, ``{prefix}rank(grp, id, rank)``, holds the ranks."""
    p = prefix
    ctes = [
        f"\n{p}g AS MATERIALIZED ({graph})",
        f"""
{p}strength AS (SELECT grp, src AS id, sum(w) AS ow FROM {p}g GROUP BY grp, src)""",
        f"""
{p}node AS MATERIALIZED (
  SELECT grp, id, coalesce(ow, 0) AS ow, count(*) OVER (PARTITION BY grp) AS n
  FROM (SELECT grp, src AS id FROM {p}g UNION SELECT grp, dst FROM {p}g)
       LEFT JOIN {p}strength USING (grp, id))""",
        f"\n{p}r0 AS MATERIALIZED (SELECT grp, id, ow, n, 1.0::DOUBLE / n AS rank FROM {p}node)",
    ]
    for i in range(1, iterations + 1):
        ctes.append(
            f"""
{p}r{i} AS MATERIALIZED (
  SELECT grp, id, ow, n,
         0.15::DOUBLE / n + 0.85::DOUBLE * coalesce(m, 0) / n + 0.85::DOUBLE * coalesce(c, 0)
           AS rank
  FROM {p}node
  LEFT JOIN (SELECT g.grp, g.dst AS id, sum(r.rank / r.ow * g.w) AS c
             FROM {p}g g JOIN {p}r{i - 1} r ON g.grp = r.grp AND g.src = r.id
             GROUP BY g.grp, g.dst) USING (grp, id)
  LEFT JOIN (SELECT grp, sum(rank) AS m FROM {p}r{i - 1} WHERE ow = 0 GROUP BY grp)
       USING (grp))"""
        )
    ctes.append(f"\n{p}rank AS (SELECT grp, id, rank FROM {p}r{iterations})")
    return ",".join(ctes)


def top(prefix: str = "", k: int = 20) -> str:
    p = prefix
    return f"""
{p}top AS (
  SELECT * FROM (
    SELECT grp, CAST(row_number() OVER (PARTITION BY grp ORDER BY round(rank, 12) DESC, id)
                     AS INTEGER) AS place, id AS email, rank AS score
    FROM {p}rank) WHERE place <= {k})"""


BASIC = _with(MAIL, pagerank(SIMPLE), top())
QUARTERLY = _with(MAIL, pagerank(SIMPLE_QUARTERLY), top())
TRACKED = f"""
seed AS (SELECT place, email FROM top WHERE place <= 5),
series AS (
  SELECT quarter, seed.place, seed.email, coalesce(q_rank.rank, 0.0::DOUBLE) AS pagerank
  FROM (SELECT DISTINCT grp AS quarter FROM q_rank) CROSS JOIN seed
       LEFT JOIN q_rank ON q_rank.grp = quarter AND q_rank.id = seed.email)"""
SERIES = _with(MAIL, pagerank(SIMPLE), top(), pagerank(SIMPLE_QUARTERLY, "q_"), TRACKED)


# ---- K-Means ----------------------------------------------------------------

def _std(column: str) -> str:
    return f"CASE WHEN var_pop({column}) > 1e-9 THEN sqrt(var_pop({column})) ELSE 1.0::DOUBLE END"


def scaled(table: str, values: list[str], id_col: str = "email") -> str:
    """CTEs ``stats(m0, s0, ...)`` and ``z(id, f0, f1, ...)`` of the value expressions."""
    values = [f"({value})::DOUBLE" for value in values]
    stats = ", ".join(
        f"avg({value}) AS m{i}, {_std(value)} AS s{i}" for i, value in enumerate(values)
    )
    scores = ", ".join(f"({value} - m{i}) / s{i} AS f{i}" for i, value in enumerate(values))
    return f"""
stats AS MATERIALIZED (SELECT {stats} FROM {table}),
z AS MATERIALIZED (SELECT {id_col} AS id, {scores} FROM {table}, stats)"""


def _nearest(centres: str, dims: int) -> str:
    distance = " + ".join(f"(z.f{i} - c.f{i}) * (z.f{i} - c.f{i})" for i in range(dims))
    return (
        f"SELECT z.*, c.cluster FROM z CROSS JOIN {centres} c "
        f"QUALIFY row_number() OVER (PARTITION BY id ORDER BY {distance}, c.cluster) = 1"
    )


def kmeans(
    k: int, iterations: int = 20, prefix: str = "", tol: float = 1e-6, dims: int = len(FEATURES)
) -> str:
    """CTEs ending in ``{prefix}centre`` and ``{prefix}member``; ``done`` marks the
    iteration after which centres stay."""
    p, cols = prefix, [f"f{i}" for i in range(dims)]
    ctes = [
        f"""
{p}c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS INTEGER) AS cluster,
         {", ".join(cols)}, false AS done
  FROM z ORDER BY md5('42:' || id), id LIMIT {k})"""
    ]
    for i in range(1, iterations + 1):
        means = ", ".join(f"avg({c}) AS {c}" for c in cols)
        kept = ", ".join(
            f"CASE WHEN c.done THEN c.{d} ELSE coalesce(m.{d}, c.{d}) END AS {d}" for d in cols
        )
        move = " + ".join(
            f"(coalesce(m.{d}, c.{d}) - c.{d}) * (coalesce(m.{d}, c.{d}) - c.{d})" for d in cols
        )
        ctes.append(
            f"""
{p}c{i} AS MATERIALIZED (
  SELECT c.cluster, {kept}, c.done OR sum({move}) OVER () < {tol} AS done
  FROM {p}c{i - 1} c
  LEFT JOIN (SELECT cluster, {means} FROM ({_nearest(f"{p}c{i - 1}", dims)}) GROUP BY cluster) m
       ON m.cluster = c.cluster)"""
        )
    ctes.append(f"\n{p}centre AS (SELECT * FROM {p}c{iterations})")
    ctes.append(f"\n{p}member AS MATERIALIZED ({_nearest(f'{p}centre', dims)})")
    return ",".join(ctes)


QUOTED_FEATURES = [f'"{c}"' for c in FEATURES]
VECTOR_DIMS = 64
POINTS = _with(MAIL, FEATURE, scaled("feature", QUOTED_FEATURES))


def _round_features(table: str, digits: int) -> str:
    return ", ".join(
        f'round({table}.f{i}, {digits}) + 0.0 AS "{c}"' for i, c in enumerate(FEATURES)
    )


def _clustered(*fits: str) -> str:
    return POINTS.rstrip() + "," + ",".join(fits) + "\n"


# ---- mails over time --------------------------------------------------------

COPY = """
copy AS MATERIALIZED (
  SELECT DISTINCT msg_id, edge.src, dst, sent FROM edge JOIN mail USING (msg_id)
  WHERE edge.ym <> 'NA')"""

PERIOD = """
period AS (
  SELECT event_id AS id, event_type, 'p' || user_id || '@en.example.com' AS src,
         make_timestamp((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) * 44
                        + epoch_us(TIMESTAMP '1998-01-01')) AS starts, value
  FROM events),
span AS (
  SELECT *, starts + to_seconds(floor(value * 3600)::BIGINT) AS ends FROM period)"""


def _clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# Seven days each from 1970-01-01 on; a week is closed, or a copy late, once the latest mail of
# the arrivals before is so many days past the end of the week.
WEEKLY = """
timed AS MATERIALIZED (
  SELECT k, edge.src, dst, sent,
         DATE '1970-01-01' + CAST(date_diff('day', DATE '1970-01-01', sent::DATE) // 7 * 7 AS INTEGER)
           AS week
  FROM edge JOIN mail USING (msg_id) WHERE edge.ym <> 'NA')"""


def _over_time() -> dict[str, str]:
    return {
        "edges_per_week_stream": _with(MAIL, WEEKLY)
        + """SELECT CAST(week AS VARCHAR) AS week_start, count(DISTINCT (src, dst)) AS edges
FROM timed WHERE week + 7 <= (SELECT max(sent) - INTERVAL 28 DAY FROM timed) GROUP BY week""",
        "late_copies_stream": _with(MAIL, WEEKLY)
        + """, marks AS (
  SELECT max(sent) FILTER (k % 10 <> 3) - INTERVAL 365 DAY AS first,
         max(sent) - INTERVAL 365 DAY AS last FROM timed),
judged AS (SELECT *, k % 10 = 3 AND week + 7 <= first AS late FROM timed, marks),
counted AS (
  SELECT count(DISTINCT week) FILTER (NOT late AND week + 7 <= last) AS weeks,
         count(DISTINCT (week, src, dst)) FILTER (NOT late AND week + 7 <= last) AS edges,
         2::BIGINT AS runs, count(*) FILTER (late) AS late_copies,
         (SELECT count(*) FROM orders) AS mails
  FROM judged)
UNPIVOT counted ON weeks, edges, runs, late_copies, mails INTO NAME measure VALUE value""",
        "reply_latency": _with(MAIL, COPY)
        + f""", asked AS (
  SELECT dst AS src, src AS dst, sent, min(msg_id) AS reply_to FROM copy GROUP BY ALL)
SELECT c.msg_id, c.src, c.dst, {_clock("c.sent")} AS sent_at, a.reply_to,
       date_diff('second', a.sent, c.sent) AS latency
FROM copy c ASOF LEFT JOIN asked a ON c.src = a.src AND c.dst = a.dst AND c.sent > a.sent""",
        "mails_in_intervals": _with(MAIL, PERIOD)
        + f"""SELECT id, count(*) AS mails, count(DISTINCT mail.src) AS senders,
  {_clock("min(sent)")} AS first_at
FROM span JOIN mail ON sent >= starts AND sent < ends
WHERE event_type = 'error' AND skip_reason IS NULL AND ym <> 'NA' GROUP BY id""",
        "mails_in_own_intervals": _with(MAIL, PERIOD)
        + """SELECT msg_id, id, event_type
FROM span JOIN mail ON mail.src = span.src AND sent >= starts AND sent < ends
WHERE skip_reason IS NULL AND k % 97 <> 0""",
        "conversation_sessions": _with(MAIL, COPY)
        + f""", paired AS (
  SELECT least(src, dst) AS a, greatest(src, dst) AS b, sent, src < dst AS from_a FROM copy),
marked AS (
  SELECT *, sent - lag(sent) OVER w > INTERVAL 180 DAY AS fresh FROM paired
  WINDOW w AS (PARTITION BY a, b ORDER BY sent)),
numbered AS (
  SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END)
            OVER (PARTITION BY a, b ORDER BY sent RANGE UNBOUNDED PRECEDING) AS run FROM marked)
SELECT a, b, {_clock("min(sent)")} AS started, {_clock("max(sent)")} AS ended, count(*) AS mails,
       count(*) FILTER (from_a) AS from_a
FROM numbered GROUP BY a, b, run""",
        "rolling_activity": _with(MAIL)
        + """, size AS (SELECT msg_id, count(*) AS copies FROM edge GROUP BY msg_id),
step AS (
  SELECT src AS email, date_diff('day', DATE '1970-01-01', sent::DATE) // 7 AS n,
         coalesce(copies, 0) AS copies
  FROM mail LEFT JOIN size USING (msg_id) WHERE skip_reason IS NULL AND ym <> 'NA')
SELECT email, CAST(DATE '1970-01-01' + CAST((n - back) * 7 AS INTEGER) AS VARCHAR) AS window_start,
       count(*) AS mails, sum(copies)::BIGINT AS copies
FROM step, range(4) AS windows(back) GROUP BY ALL""",
        "active_streaks": _with(MAIL)
        + """, month AS (
  SELECT DISTINCT src AS email, ym, year(sent) * 12 + month(sent) AS n FROM mail
  WHERE skip_reason IS NULL AND ym <> 'NA'),
island AS (
  SELECT *, n - row_number() OVER w AS start, n - lag(n) OVER w - 1 AS silence FROM month
  WINDOW w AS (PARTITION BY email ORDER BY n)),
run AS (
  SELECT email, count(*) AS months, max(silence) AS silence, min(ym) AS a, max(ym) AS b
  FROM island GROUP BY email, start)
SELECT email, sum(months)::BIGINT AS months, max(months) AS longest_streak,
       coalesce(max(silence), 0)::INTEGER AS longest_silence, min(a) AS first_month,
       max(b) AS last_month
FROM run GROUP BY email""",
    }


# ---- mails of the second corpus ---------------------------------------------


def _odd(headers_only: bool) -> str:
    """CTE ``odd``: what the rules give for each of the twelve forms of a mail."""
    body_to = "'no_recipient_field'" if headers_only else "NULL"
    return f"""
form AS (
  SELECT o_orderkey AS k, o_orderkey % 12 AS form, o_orderkey // 12 % 3 AS zone,
         'p' || o_custkey || '@en.example.com' AS s,
         'p' || (o_custkey + 1) || '@en.example.com' AS a,
         'p' || (o_custkey + 2) || '@en.example.com' AS b,
         o_orderdate + INTERVAL 34215 SECOND AS day
  FROM orders),
reason AS (
  SELECT *, CASE WHEN form < 2 THEN 'blank_message' WHEN form IN (2, 10) THEN 'no_sender'
                 WHEN form = 5 THEN {body_to} WHEN form = 7 THEN 'no_recipient_field'
                 WHEN form = 6 THEN 'invalid_sender' END AS skip_reason,
         CASE WHEN form IN (0, 1, 3) OR form = 9 AND zone = 2 THEN NULL
              WHEN form = 8 THEN TIMESTAMP '2001-01-01' + to_seconds(k + 10000000)
              WHEN form = 9 AND zone = 0 THEN day - INTERVAL 5 HOUR
              WHEN form = 9 THEN day + INTERVAL 8 HOUR
              WHEN form = 11 THEN day + INTERVAL 570 MINUTE ELSE day END AS sent
  FROM form),
odd AS MATERIALIZED (
  SELECT 'odd/' || k || '.' AS msg_id,
         CASE WHEN form IN (0, 1, 2, 10) THEN '' WHEN form = 6 THEN 'mailer daemon' ELSE s END AS src,
         CASE WHEN skip_reason IS NOT NULL THEN '' WHEN form IN (3, 4) THEN a || ',' || b
              WHEN form = 11 THEN a || ',' || a ELSE a END AS "to",
         CASE WHEN skip_reason IS NULL AND form = 5 THEN b ELSE '' END AS cc,
         strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent_at,
         CASE WHEN year(sent) BETWEEN 1998 AND 2002 THEN strftime(sent, '%Y-%m') ELSE 'NA' END AS ym,
         CAST(hour(sent) AS INTEGER) AS hour, skip_reason
  FROM reason)"""


def _odd_mails() -> dict[str, str]:
    return {
        "odd_mails": _with(_odd(False)) + "SELECT * FROM odd",
        "odd_mails_headers_only": _with(_odd(True)) + "SELECT * FROM odd",
        "skip_reasons_all": _with(MAIL, _odd(False))
        + """SELECT coalesce(skip_reason, 'valid') AS skip_reason, count(*) AS mails
FROM (SELECT skip_reason FROM mail UNION ALL SELECT skip_reason FROM odd) GROUP BY ALL""",
    }


# ---- traffic, formats and SQL -----------------------------------------------

CHURN = f"""
pair AS (
  SELECT src, dst, {QUARTER} AS quarter, year(strptime(ym, '%Y-%m')) * 4
         + quarter(strptime(ym, '%Y-%m')) AS q, count(*) AS n
  FROM edge WHERE ym <> 'NA' GROUP BY ALL),
compared AS (
  SELECT src, dst, q, sum(now) AS now, sum(earlier) AS earlier FROM (
    SELECT src, dst, q, n AS now, 0 AS earlier FROM pair
    UNION ALL SELECT src, dst, q + 1, 0, n FROM pair) GROUP BY ALL)"""


def _traffic() -> dict[str, str]:
    mail = _with(MAIL)
    edges = mail + "SELECT src, dst, type, ym FROM edge"
    quarters = ["'1998-Q1'", "'1998-Q2'"]
    of = [f"SELECT src, dst, type FROM edge WHERE ym <> 'NA' AND {QUARTER} = {q}" for q in quarters]
    return {
        "traffic_cube": mail
        + f"""SELECT CAST(grouping(type, quarter, domain) AS INTEGER) AS level, type, quarter, domain,
  count(*) AS copies, count(DISTINCT src) AS senders
FROM (SELECT type, CASE WHEN ym <> 'NA' THEN {QUARTER} END AS quarter,
             split_part(dst, '@', 2) AS domain, src FROM edge)
GROUP BY CUBE (type, quarter, domain)""",
        "calendar_rollup": mail
        + f"""SELECT CAST(grouping(year, quarter, month) AS INTEGER) AS level, year, quarter, month,
  count(*) AS copies, count(DISTINCT src) AS senders
FROM (SELECT substr(ym, 1, 4) AS year, {QUARTER} AS quarter, ym AS month, src
      FROM edge WHERE ym <> 'NA')
GROUP BY ROLLUP (year, quarter, month)""",
        "edge_churn": _with(MAIL, CHURN)
        + """SELECT ((q - 1) // 4) || '-Q' || ((q - 1) % 4 + 1) AS quarter, sum(now)::BIGINT AS copies,
  sum(now - least(now, earlier))::BIGINT AS gained,
  sum(earlier - least(now, earlier))::BIGINT AS lost, sum(least(now, earlier))::BIGINT AS kept
FROM compared GROUP BY q HAVING sum(now) > 0""",
        "edge_changes": mail
        + f"""SELECT *, 'lost' AS change FROM ({of[0]} EXCEPT ALL {of[1]})
UNION ALL SELECT *, 'gained' FROM ({of[1]} EXCEPT ALL {of[0]})
UNION ALL SELECT *, 'kept' FROM ({of[0]} INTERSECT ALL {of[1]})""",
        "header_map": _with(MAIL, FIELDS)
        + """, named AS (
  SELECT msg_id AS file, unnest(['Message-ID', 'Date', 'From', 'To', 'Subject', 'Cc', 'X-From']) AS name,
         unnest(['<' || k || '@en.example.com>', date_text, from_text, to_list, 'order ' || k, cc_list,
                 '"Sales"']) AS found
  FROM field)
SELECT * FROM named WHERE found IS NOT NULL""",
        "json_edges": edges,
        "json_corrupt": mail
        + """SELECT CASE WHEN k % 7 = 0 THEN 'corrupt' WHEN k % 11 = 0 THEN 'unknown field'
            ELSE 'whole' END AS kind, count(*) AS mails,
  CAST(sum(CASE WHEN k % 7 <> 0 AND k % 11 = 0 THEN k END) AS BIGINT) AS size
FROM mail GROUP BY kind""",
        "edges_orc": edges,
        "edges_json": edges,
        "edges_bucketed": mail
        + """SELECT src, dst, count(*) AS copies, CAST(sum(count(*)) OVER (PARTITION BY src) AS BIGINT) AS sent
FROM edge GROUP BY src, dst""",
        "sql_quarter_sizes": mail
        + f"""SELECT quarter, count(*) AS edges FROM
  (SELECT DISTINCT {QUARTER} AS quarter, src, dst FROM edge WHERE ym <> 'NA') GROUP BY quarter""",
        "sql_edge_weights": mail + f"SELECT src, dst, {RAW} AS w FROM edge GROUP BY src, dst",
        "sql_correspondents": mail
        + """SELECT email, sum(sent)::BIGINT AS sent, sum(received)::BIGINT AS received FROM (
  SELECT dst AS email, 1 AS sent, 0 AS received FROM edge WHERE src = 'p7@en.example.com'
  UNION ALL SELECT src, 0, 1 FROM edge WHERE dst = 'p7@en.example.com') GROUP BY email""",
    }


def oracle_sql() -> dict[str, str]:
    return _mail_graph() | _over_time() | _odd_mails() | _traffic()


def _mail_graph() -> dict[str, str]:
    mail, fields = _with(MAIL), _with(MAIL, FIELDS)
    tokens = _with(MAIL, TOKEN)
    features = _with(MAIL, FEATURE)
    messages = (
        fields
        + r"""SELECT msg_id AS file,
  'Message-ID: <' || k || '@en.example.com>' || chr(10) || 'Date: ' || date_text
  || chr(10) || 'From: ' || from_text || chr(10)
  || coalesce('To: ' || replace(to_list, mark, rtrim(mark) || chr(10) || chr(9)) || chr(10), '')
  || 'Subject: order ' || k || chr(10)
  || coalesce('Cc: ' || replace(cc_list, mark, rtrim(mark) || chr(10) || chr(9)) || chr(10), '')
  || 'X-From: "Sales"' || chr(10) || chr(10) || 'Order ' || k || ' is "on its way".'
  || chr(10) || chr(10) || '  To: whom it may concern, no header' || chr(10) || 'Regards'
  || chr(10) AS message
FROM field"""
    )
    edges = mail + "SELECT src, dst, type, ym FROM edge"
    directory = mail + """SELECT src AS email FROM mail WHERE skip_reason IS NULL
UNION SELECT dst FROM edge"""
    return {
        "read_messages": messages,
        "read_large_dump": messages,
        "incremental_edges": edges,
        "edges_roundtrip": edges,
        "edges": edges,
        "tracked_seed": BASIC
        + "SELECT place AS rank, email, round(score, 10) AS pagerank FROM top WHERE place <= 5",
        "header_fields": fields
        + """SELECT msg_id AS file, false AS is_blank, from_text, coalesce(to_list, '') AS to_text,
  coalesce(cc_list, '') AS cc_text, date_text FROM field""",
        "persons": directory,
        "persons_roundtrip": directory,
        "clean_address": tokens
        + """SELECT token, CASE WHEN person % 50 <> 0 AND line % 3 = 2 THEN plain ELSE token END
  AS address, count(*) AS times FROM token JOIN mail USING (k) GROUP BY ALL""",
        "valid_address": tokens
        + """SELECT person % 50 <> 0 AS is_valid, count(*) AS tokens FROM token
JOIN mail USING (k) GROUP BY ALL""",
        "recipients": mail + "SELECT msg_id, src, dst, type, ym, hour FROM edge",
        "skip_reasons": mail
        + """SELECT coalesce(skip_reason, 'valid') AS skip_reason, count(*) AS mails
FROM mail GROUP BY ALL""",
        "sent_month": mail + "SELECT msg_id, ym FROM mail",
        "sent_local": mail
        + """, local AS (
  SELECT *, (sent AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS there FROM mail)
SELECT msg_id, CASE WHEN k % 97 <> 0 AND year(there) BETWEEN 1998 AND 2002
         THEN strftime(there, '%Y-%m') ELSE 'NA' END AS ym,
       -- in the year 1 the city's own mean time was 5:50:36 behind
       CAST(CASE WHEN k % 97 = 0 THEN (k + 18) % 24 ELSE hour(there) END AS INTEGER) AS hour
FROM local""",
        "edges_headers_only": edges,
        "sent_hour": mail + "SELECT msg_id, hour FROM mail",
        "ingest_metrics": mail
        + """SELECT 'mails' AS metric, count(*) AS value FROM mail
UNION ALL SELECT 'valid', count(*) FROM mail WHERE skip_reason IS NULL
UNION ALL SELECT 'skipped', count(*) FROM mail WHERE skip_reason IS NOT NULL
UNION ALL SELECT 'edges', count(*) FROM edge
UNION ALL SELECT 'na_dates', count(*) FROM mail WHERE skip_reason IS NULL AND ym = 'NA'
UNION ALL SELECT 'persons', count(*) FROM
  (SELECT src FROM mail WHERE skip_reason IS NULL UNION SELECT dst FROM edge)""",
        "scale_summary": mail
        + f"""SELECT (SELECT count(*) FROM mail WHERE skip_reason IS NULL) AS mails,
  (SELECT count(*) FROM (SELECT src FROM mail WHERE skip_reason IS NULL
                         UNION SELECT dst FROM edge)) AS nodes,
  count(*) AS edges, min(ym) FILTER (ym <> 'NA') AS first_month,
  max(ym) FILTER (ym <> 'NA') AS last_month,
  count(DISTINCT CASE WHEN ym <> 'NA' THEN {QUARTER} END) AS quarters
FROM edge""",
        "simple_graph": mail + "SELECT DISTINCT src, dst FROM edge",
        "graph_nodes": mail + "SELECT src AS id FROM edge UNION SELECT dst FROM edge",
        "out_degree": mail
        + """SELECT src AS id, count(DISTINCT dst) AS out_degree,
  count(DISTINCT dst)::DOUBLE AS out_weight FROM edge GROUP BY src""",
        "dangling_nodes": mail + "SELECT dst AS id FROM edge EXCEPT SELECT src FROM edge",
        "edge_weights_freq": mail + f"SELECT src, dst, {RAW} AS w FROM edge GROUP BY src, dst",
        "edge_weights_log": mail
        + f"SELECT src, dst, round(1 + ln(1 + {RAW}), 10) AS w FROM edge GROUP BY src, dst",
        "quarter_edges": mail
        + f"SELECT src, dst, type, ym, {QUARTER} AS quarter FROM edge WHERE ym <> 'NA'",
        "quarter_sizes": mail
        + f"""SELECT quarter, count(*) AS edges FROM
  (SELECT DISTINCT {QUARTER} AS quarter, src, dst FROM edge WHERE ym <> 'NA') GROUP BY quarter""",
        "pagerank": BASIC + "SELECT id, round(rank, 10) AS rank FROM rank",
        "pagerank_freq": _with(MAIL, pagerank(FREQ))
        + "SELECT id, round(rank, 10) AS rank FROM rank",
        "pagerank_log": _with(MAIL, pagerank(LOG)) + "SELECT id, round(rank, 10) AS rank FROM rank",
        "pagerank_quarterly": QUARTERLY
        + "SELECT grp AS quarter, id, round(rank, 10) AS rank FROM rank",
        "edges_short_lines": _with(
            MAIL,
            """
numbered AS (
  SELECT *, CAST(regexp_extract(dst, '[0-9]+') AS BIGINT) % 5 AS number FROM edge),
listed AS (
  SELECT CASE WHEN number = 0 THEN 2 WHEN number = 2 THEN 3 ELSE 4 END AS size,
         CASE WHEN number >= 3 AND type = 'cc' THEN 0.5 ELSE 1.0 END::DOUBLE AS weight,
         CASE WHEN number NOT IN (0, 2) AND ym <> 'NA' THEN 1 END AS dated
  FROM numbered)""",
        )
        + """, counted AS (
  SELECT CAST(f AS INTEGER) AS fields, (count(*) FILTER (size >= f))::DOUBLE AS kept,
         sum(weight) FILTER (size >= f) AS weight,
         (count(dated) FILTER (size >= f))::DOUBLE AS dated,
         (count(*) FILTER (size < f))::DOUBLE AS left_out
  FROM listed, range(2, 5) AS needed(f) GROUP BY f)
UNPIVOT counted ON kept, weight, dated, left_out INTO NAME measure VALUE value""",
        "pagerank_step": _with(MAIL, pagerank(SIMPLE, iterations=1))
        + "SELECT id, round(rank, 10) AS rank FROM rank",
        "rank_mass": QUARTERLY
        + """SELECT grp AS quarter, count(*) AS nodes, round(sum(rank), 9) AS mass
FROM rank GROUP BY grp""",
        "top20": BASIC + "SELECT place AS rank, email, round(score, 10) AS pagerank FROM top",
        "top20_quarterly": QUARTERLY
        + "SELECT grp AS quarter, place AS rank, email, round(score, 10) AS pagerank FROM top",
        "tracked_series": SERIES
        + "SELECT quarter, email, round(pagerank, 10) AS pagerank FROM series",
        "series_wide": SERIES
        + "SELECT quarter, "
        + ", ".join(
            f"round(max(pagerank) FILTER (place = {i}), 10) AS seed_{i}" for i in range(1, 6)
        )
        + " FROM series GROUP BY quarter",
        "series_wide_capped": SERIES
        + "SELECT quarter, "
        + ", ".join(
            f"round(least(max(pagerank) FILTER (place = {i}), 0.001::DOUBLE), 10) AS seed_{i}"
            for i in range(1, 6)
        )
        + " FROM series GROUP BY quarter",
        "peak_quarter": SERIES
        + """SELECT email, quarter, round(pagerank, 10) AS pagerank FROM series
QUALIFY row_number() OVER (PARTITION BY email ORDER BY round(pagerank, 12) DESC, quarter) = 1""",
        "quarter_winner": QUARTERLY
        + "SELECT grp AS quarter, email, round(score, 10) AS pagerank FROM top WHERE place = 1",
        "global_vs_quarterly": _with(
            MAIL, pagerank(SIMPLE), top(), pagerank(SIMPLE_QUARTERLY, "q_"), top("q_")
        )
        + """SELECT top.place AS global_rank, top.email, count(q_top.place) AS quarters_in_top,
  min(q_top.place) AS best_rank, median(q_top.place)::DOUBLE AS median_rank
FROM top LEFT JOIN q_top ON q_top.email = top.email GROUP BY top.place, top.email""",
        "rank_compare": _with(
            MAIL,
            pagerank(SIMPLE),
            top(),
            pagerank(LOG, "l_"),
            top("l_"),
            pagerank(FREQ, "f_"),
            top("f_"),
        )
        + """, moved AS (
  SELECT email, top.place AS basic_rank, l_top.place AS log_rank, f_top.place AS freq_rank
  FROM top FULL JOIN l_top USING (email) FULL JOIN f_top USING (email))
SELECT *, basic_rank - log_rank AS log_move, basic_rank - freq_rank AS freq_move,
"""
        + ", ".join(
            f"""CASE WHEN basic_rank IS NULL AND {c}_rank IS NULL THEN 'absent'
  WHEN {c}_rank IS NULL THEN 'dropped' WHEN basic_rank IS NULL THEN 'new'
  WHEN {c}_rank < basic_rank THEN 'up' WHEN {c}_rank > basic_rank THEN 'down'
  ELSE 'same' END AS {c}_status"""
            for c in ("log", "freq")
        )
        + " FROM moved",
        "sent_recv": features + "SELECT email, sent, recv FROM counts",
        "degrees": features + "SELECT email, out_degree, in_degree FROM counts",
        "night_ratio": features
        + 'SELECT email, night, "nightRatio" FROM counts JOIN feature USING (email)',
        "active_months": features + 'SELECT email, "activeMonths" FROM feature',
        "person_features": features + "SELECT * FROM feature",
        "features_roundtrip": features + "SELECT * FROM feature",
        "feature_stats": POINTS
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(m{i}, 8) AS mean, round(s{i}, 8) AS std FROM stats"
            for i, c in enumerate(FEATURES)
        ),
        "zscores": POINTS + f"SELECT id AS email, {_round_features('z', 8)} FROM z",
        "init_centroids": _clustered(kmeans(4, 1))
        + f"SELECT cluster, {_round_features('c0', 8)} FROM c0",
        "kmeans_assign": _clustered(kmeans(3, 0)) + "SELECT id AS email, cluster FROM member",
        "kmeans_step": _clustered(kmeans(3, 1))
        + f"SELECT cluster, {_round_features('centre', 6)} FROM centre",
        "kmeans": _clustered(kmeans(3, 5))
        + f"SELECT cluster, {_round_features('centre', 6)} FROM centre",
        "kmeans_k3": _clustered(kmeans(3)) + "SELECT id AS email, cluster FROM member",
        "kmeans_k4": _clustered(kmeans(4)) + "SELECT id AS email, cluster FROM member",
        "kmeans_embeddings": _with(
            scaled("embeddings", [f"embedding[{i + 1}]" for i in range(VECTOR_DIMS)], "vec_id"),
            kmeans(4, dims=VECTOR_DIMS),
        )
        + "SELECT id AS vec_id, cluster FROM member",
        "cluster_sizes": _clustered(kmeans(4))
        + "SELECT cluster, count(*) AS people FROM member GROUP BY cluster",
        "cluster_centers": _clustered(kmeans(4))
        + "SELECT cluster, "
        + ", ".join(
            f'round(f{i} * s{i} + m{i}, 6) + 0.0 AS "{c}"' for i, c in enumerate(FEATURES)
        )
        + " FROM centre, stats",
        "cluster_profile": _clustered(kmeans(4))
        + "SELECT 4 AS k, cluster, 'group_' || cluster AS label, count(*) AS people, "
        + ", ".join(f'round(avg("{c}"::DOUBLE), 6) AS "{c}"' for c in FEATURES)
        + " FROM member JOIN feature ON id = email GROUP BY cluster",
        "cluster_crosstab": _clustered(kmeans(3, prefix="a_"), kmeans(4, prefix="b_"))
        + """SELECT a_member.cluster AS left_cluster, b_member.cluster AS right_cluster,
  count(*) AS people FROM a_member JOIN b_member USING (id) GROUP BY ALL""",
    }
