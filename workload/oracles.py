"""SQL counterparts of the registered queries, written independently of the Spark plans."""

from __future__ import annotations

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# The role views of workload.roles.
BEHAVIOR = """
behavior AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts
  FROM events
)"""
ACCESS = """
access AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN 'GET' ELSE 'POST' END AS method,
         '/page/' || json_extract_string(props, '$.k') AS url, ts
  FROM events
)"""
DELAYED = f"""{ACCESS},
delayed AS (
  SELECT event_id, user_id, method, url,
         CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ts
  FROM access
)"""
AD_CLICKS = """
clicks AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS ad_id,
         'region ' || (user_id % 7) AS province,
         ts, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day
  FROM events
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS day_rank FROM clicks
)"""
LOGINS = """
logins AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, ts
  FROM events
)"""


def windows(source: str, keys: str, size: int, slide: int, where: str = "TRUE", low: str | None = None) -> str:
    """Every row copied once per window it belongs to, then counted."""
    first = f"(epoch_us(ts) - {size}) // {slide} + 1"
    if low is not None:
        first = f"greatest({first}, {low})"
    key_list = f"{keys}, " if keys else ""
    return f"""
  SELECT {key_list}make_timestamp(i * {slide}) AS window_start, make_timestamp(i * {slide} + {size}) AS window_end,
         count(*) AS cnt
  FROM (SELECT {key_list}unnest(range({first}, epoch_us(ts) // {slide} + 1)) AS i FROM {source} WHERE {where})
  GROUP BY {key_list}i"""


def top(counts: str, key: str, n: int) -> str:
    return f"""
SELECT {key}, window_end, cnt, CAST(row_num AS INTEGER) AS row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS row_num FROM ({counts})
) WHERE row_num <= {n}"""


HOT_ITEMS = top(windows("behavior", "item_id", HOUR, 5 * MINUTE, "behavior = 'pv'"), "item_id", 5)

# Watermark as each row arrives: greatest earlier time less 3 s; a window closes 1 ms before its end plus 60 s.
WATERMARKED = f"""
{DELAYED},
arrived AS (
  SELECT *, max(epoch_us(ts)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - {3 * SECOND} AS wm
  FROM delayed
),
classified AS (
  SELECT *, coalesce(epoch_us(ts) // {5 * SECOND} * {5 * SECOND} + {10 * MINUTE} - 1000 + {MINUTE} <= wm, FALSE)
            AS is_late
  FROM arrived
)"""
FIRST_OPEN = f"coalesce((wm + 1000 - {MINUTE} - {10 * MINUTE}) // {5 * SECOND} + 1, 0)"

HASH = """list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(CAST(user_id AS VARCHAR), ''),
          lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: (a * 61 + b) & 536870911)"""


def running(visitor: str) -> str:
    return f"""
WITH {BEHAVIOR},
seen AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, {visitor} AS visitor, ts, event_id
  FROM behavior WHERE behavior = 'pv'
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY window_end, visitor ORDER BY ts, event_id) AS nth FROM seen
)
SELECT window_end, visitor, ts, event_id,
       row_number() OVER (PARTITION BY window_end ORDER BY ts, event_id) AS cnt
FROM firsts WHERE nth = 1"""


def hourly(measure: str) -> str:
    return f"""
WITH {BEHAVIOR}
SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, CAST({measure} AS BIGINT) AS cnt
FROM behavior WHERE behavior = 'pv' GROUP BY 1"""


def pairs(source: str, order: str) -> str:
    return f"""
WITH {LOGINS}, stepped AS ({source}),
placed AS (
  SELECT *, lag(event_type) OVER w AS prev_type, lag(ts) OVER w AS prev_ts, lag(event_id) OVER w AS prev_id
  FROM stepped WINDOW w AS (PARTITION BY user_id ORDER BY {order})
)
SELECT user_id, prev_ts AS first_ts, ts AS last_ts, prev_id AS first_seq, event_id AS last_seq
FROM placed
WHERE event_type = 'fail' AND prev_type = 'fail' AND epoch_us(ts) - epoch_us(prev_ts) <= {6 * HOUR}"""


TRIPLES = f"""
WITH {LOGINS},
placed AS (
  SELECT *, lag(event_type, 1) OVER w AS t1, lag(event_type, 2) OVER w AS t2,
         lag(ts, 1) OVER w AS ts1, lag(ts, 2) OVER w AS ts2,
         lag(event_id, 1) OVER w AS id1, lag(event_id, 2) OVER w AS id2
  FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
hits AS (
  SELECT * FROM placed
  WHERE event_type = 'fail' AND t1 = 'fail' AND t2 = 'fail' AND epoch_us(ts) - epoch_us(ts2) < {DAY}
)"""

BURSTS = f"""
WITH RECURSIVE {LOGINS},
numbered AS (
  SELECT *, epoch_us(ts) AS us,
         count(*) FILTER (WHERE event_type <> 'fail')
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
  FROM logins
),
fails AS (SELECT * FROM numbered WHERE event_type = 'fail'),
anchors AS (
  SELECT user_id, run, min(us) AS a FROM fails GROUP BY user_id, run
  UNION ALL
  SELECT x.user_id, x.run, min(f.us) FROM anchors x
  JOIN fails f ON f.user_id = x.user_id AND f.run = x.run AND f.us > x.a + {2 * DAY}
  GROUP BY x.user_id, x.run
),
bursts AS (
  SELECT x.user_id, x.run, x.a, min(f.event_id) FILTER (WHERE f.us = x.a) AS first_seq, max(f.us) AS last_us,
         count(*) AS n
  FROM anchors x JOIN fails f
    ON f.user_id = x.user_id AND f.run = x.run AND f.us BETWEEN x.a AND x.a + {2 * DAY}
  GROUP BY x.user_id, x.run, x.a
)
SELECT b.user_id, make_timestamp(b.a) AS first_ts, b.first_seq, make_timestamp(b.last_us) AS last_ts, b.n AS n_fails
FROM bursts b LEFT JOIN numbered s
  ON s.user_id = b.user_id AND s.event_type <> 'fail' AND s.run = b.run + 1
WHERE b.n >= 3 AND (s.us IS NULL OR s.us > b.a + {2 * DAY})"""

PAY_PATTERN = f"""
WITH later AS (
  SELECT c.event_id, c.user_id, c.ts, min(p.ts) AS pay_ts, arg_min(p.event_id, p.ts) AS pay_id
  FROM events c LEFT JOIN events p
    ON p.user_id = c.user_id AND p.event_type = 'purchase' AND p.ts > c.ts AND p.ts < c.ts + INTERVAL 1 DAY
  WHERE c.event_type = 'signup'
  GROUP BY c.event_id, c.user_id, c.ts
)
SELECT user_id AS order_id, ts AS create_ts, event_id AS create_seq, pay_ts, pay_id AS pay_seq,
       CASE WHEN pay_ts IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
       coalesce(pay_ts, ts + INTERVAL 1 DAY) AS "at"
FROM later"""

PAY_OUTCOMES = f"""
WITH steps AS (
  SELECT *, lag(event_type) OVER w AS prev_type, lead(event_type) OVER w AS next_type,
         lead(ts) OVER w AS next_ts, lead(event_id) OVER w AS next_id
  FROM events WHERE event_type IN ('signup', 'purchase')
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END, event_id)
),
creates AS (
  SELECT *, coalesce(next_type = 'purchase', FALSE) AS closed FROM steps WHERE event_type = 'signup'
)
SELECT user_id AS order_id,
       CASE WHEN NOT closed THEN 'timeout' WHEN epoch_us(next_ts) - epoch_us(ts) < {DAY} THEN 'paid'
            ELSE 'paid_late' END AS outcome,
       ts AS open_ts, event_id AS open_seq, CASE WHEN closed THEN next_ts END AS close_ts,
       CASE WHEN closed THEN next_id END AS close_seq,
       CASE WHEN closed THEN next_ts ELSE ts + INTERVAL 1 DAY END AS "at"
FROM creates
UNION ALL
SELECT user_id, 'orphan_pay', NULL, NULL, ts, event_id, ts
FROM steps WHERE event_type = 'purchase' AND coalesce(prev_type, 'purchase') = 'purchase'"""

FOLLOWED_BY_3 = """
WITH v AS (
  SELECT s.event_id, s.user_id, s.ts, min(n.ts) AS v_ts, arg_min(n.event_id, n.ts) AS v_id
  FROM events s LEFT JOIN events n
    ON n.user_id = s.user_id AND n.event_type = 'view' AND n.ts > s.ts AND n.ts < s.ts + INTERVAL 3 DAY
  WHERE s.event_type = 'signup' GROUP BY s.event_id, s.user_id, s.ts
),
p AS (
  SELECT v.event_id, v.user_id, v.ts, v.v_ts, v.v_id, min(n.ts) AS p_ts, arg_min(n.event_id, n.ts) AS p_id
  FROM v LEFT JOIN events n
    ON n.user_id = v.user_id AND n.event_type = 'purchase' AND n.ts > v.v_ts AND n.ts < v.ts + INTERVAL 3 DAY
  GROUP BY v.event_id, v.user_id, v.ts, v.v_ts, v.v_id
)
SELECT user_id, ts AS signup_ts, event_id AS signup_seq, v_ts AS view_ts, v_id AS view_seq, p_ts AS purchase_ts,
       p_id AS purchase_seq, CASE WHEN p_ts IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
       coalesce(p_ts, ts + INTERVAL 3 DAY) AS "at"
FROM p"""

NEXT_CHAIN = """
WITH placed AS (
  SELECT *, lead(event_type) OVER w AS n_type, lead(ts) OVER w AS n_ts, lead(event_id) OVER w AS n_id
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
v AS (
  SELECT *, coalesce(n_ts < ts + INTERVAL 2 DAY, FALSE) AS in_time FROM placed WHERE event_type = 'view'
),
alive AS (
  SELECT event_id, user_id, ts, CASE WHEN in_time THEN n_ts END AS c_ts, CASE WHEN in_time THEN n_id END AS c_id
  FROM v WHERE NOT in_time OR n_type = 'click'
),
p AS (
  SELECT a.event_id, a.user_id, a.ts, a.c_ts, a.c_id, min(n.ts) AS p_ts, arg_min(n.event_id, n.ts) AS p_id
  FROM alive a LEFT JOIN events n
    ON n.user_id = a.user_id AND n.event_type = 'purchase' AND n.ts > a.c_ts AND n.ts < a.ts + INTERVAL 2 DAY
  GROUP BY a.event_id, a.user_id, a.ts, a.c_ts, a.c_id
)
SELECT user_id, ts AS view_ts, event_id AS view_seq, c_ts AS click_ts, c_id AS click_seq, p_ts AS purchase_ts,
       p_id AS purchase_seq, CASE WHEN p_ts IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
       coalesce(p_ts, ts + INTERVAL 2 DAY) AS "at"
FROM p"""

TX = """
pays AS (SELECT CAST(user_id AS VARCHAR) AS tx_id, event_id, ts FROM events WHERE event_type = 'purchase'),
receipts AS (SELECT CAST(user_id AS VARCHAR) AS tx_id, event_id, ts FROM events WHERE event_type = 'click')"""
NEAR = "l.tx_id = r.tx_id AND r.ts BETWEEN l.ts - INTERVAL 3 HOUR AND l.ts + INTERVAL 5 HOUR"

# Two pointers per transaction: drop whichever head came too early for the other, else pair the heads.
RECONCILE = f"""
WITH RECURSIVE {TX},
l AS (SELECT tx_id, list(epoch_us(ts) ORDER BY ts, event_id) AS t, list(event_id ORDER BY ts, event_id) AS id
      FROM pays GROUP BY tx_id),
r AS (SELECT tx_id, list(epoch_us(ts) ORDER BY ts, event_id) AS t, list(event_id ORDER BY ts, event_id) AS id
      FROM receipts GROUP BY tx_id),
both_sides AS (
  SELECT coalesce(l.tx_id, r.tx_id) AS tx_id, coalesce(l.t, []) AS lt, coalesce(l.id, []) AS lid,
         coalesce(r.t, []) AS rt, coalesce(r.id, []) AS rid
  FROM l FULL JOIN r ON l.tx_id = r.tx_id
),
walk AS (
  SELECT tx_id, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS j, CAST(NULL AS VARCHAR) AS outcome,
         CAST(NULL AS BIGINT) AS li, CAST(NULL AS BIGINT) AS ri
  FROM both_sides
  UNION ALL
  SELECT tx_id, i + CASE WHEN step <> 'single_receipt' THEN 1 ELSE 0 END,
         j + CASE WHEN step <> 'single_pay' THEN 1 ELSE 0 END, step,
         CASE WHEN step <> 'single_receipt' THEN i END, CASE WHEN step <> 'single_pay' THEN j END
  FROM (
    SELECT w.tx_id, w.i, w.j,
           CASE WHEN w.i > len(lt) THEN 'single_receipt'
                WHEN w.j > len(rt) THEN 'single_pay'
                WHEN rt[w.j] - lt[w.i] > {5 * HOUR} THEN 'single_pay'
                WHEN rt[w.j] - lt[w.i] < -{3 * HOUR} THEN 'single_receipt'
                ELSE 'matched' END AS step
    FROM walk w JOIN both_sides b ON b.tx_id = w.tx_id
    WHERE w.i <= len(lt) OR w.j <= len(rt)
  )
)
SELECT w.tx_id, outcome, make_timestamp(lt[li]) AS pay_ts, lid[li] AS pay_seq, make_timestamp(rt[ri]) AS receipt_ts,
       rid[ri] AS receipt_seq
FROM walk w JOIN both_sides b ON b.tx_id = w.tx_id WHERE outcome IS NOT NULL"""

# The same over the rows that have an id and a time; the others are single.
TX_PATCHY = """
all_pays AS (SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS tx_id, event_id,
                    CASE WHEN event_id % 11 <> 0 THEN ts END AS ts FROM events WHERE event_type = 'purchase'),
all_receipts AS (SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS tx_id, event_id,
                        CASE WHEN event_id % 11 <> 0 THEN ts END AS ts FROM events WHERE event_type = 'click'),
pays AS (SELECT * FROM all_pays WHERE tx_id IS NOT NULL AND ts IS NOT NULL),
receipts AS (SELECT * FROM all_receipts WHERE tx_id IS NOT NULL AND ts IS NOT NULL)"""
RECONCILE_PATCHY = RECONCILE.replace(TX, TX_PATCHY) + """
UNION ALL
SELECT tx_id, 'single_pay', ts, event_id, NULL, NULL FROM all_pays WHERE tx_id IS NULL OR ts IS NULL
UNION ALL
SELECT tx_id, 'single_receipt', NULL, NULL, ts, event_id FROM all_receipts WHERE tx_id IS NULL OR ts IS NULL"""

TRIPLE_PATTERN = f"""
{TRIPLES}
SELECT user_id, ts2 AS fail_1_ts, id2 AS fail_1_seq, ts1 AS fail_2_ts, id1 AS fail_2_seq, ts AS fail_3_ts,
       event_id AS fail_3_seq FROM hits"""
INTERVAL_OUTER = f"""
WITH {TX}
SELECT coalesce(l.tx_id, r.tx_id) AS tx_id, l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id,
       r.ts AS r_ts,
       CASE WHEN r.event_id IS NULL THEN 'single_pay' WHEN l.event_id IS NULL THEN 'single_receipt'
            ELSE 'matched' END AS outcome
FROM pays l FULL JOIN receipts r ON {NEAR}"""

# Eight stretches of arrivals by number; the watermark of a stretch comes from those before it.
STRETCHES = f"""
WITH clicks AS (
  SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END AS ts FROM events WHERE event_type = 'click'
),
requests AS (
  SELECT *, (event_id - min(event_id) OVER ()) * 8 // (max(event_id) OVER () - min(event_id) OVER () + 1) AS stretch FROM clicks
),
reached AS (
  SELECT stretch, max(max(epoch_us(ts))) OVER (ORDER BY stretch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                  - {3 * SECOND} AS wm
  FROM requests GROUP BY stretch
)"""

# A window answers when a watermark passes its end, and again for every later stretch with rows for it.
CORRECTED = f"""
{STRETCHES},
entered AS (
  SELECT user_id % 5 AS part, stretch, coalesce(wm, 0) AS wm, unnest(range((epoch_us(ts) - {DAY}) // {12 * HOUR} + 1, epoch_us(ts) // {12 * HOUR} + 1)) AS i
  FROM requests JOIN reached USING (stretch)
),
timed AS (SELECT *, i * {12 * HOUR} + {DAY} - 1000 AS closes FROM entered),
judged AS (SELECT *, closes + {2 * DAY} <= wm AS too_late, closes <= wm AS closed FROM timed)
SELECT part, make_timestamp(i * {12 * HOUR} + {DAY}) AS window_end, nullif(count(*) FILTER (WHERE NOT too_late), 0) AS cnt,
       count(DISTINCT stretch) FILTER (WHERE closed AND NOT too_late) + max(CASE WHEN NOT closed THEN 1 ELSE 0 END) AS answers,
       count(*) FILTER (WHERE too_late) AS late
FROM judged GROUP BY part, i"""
LATE_BY_STRETCH = f"""
{STRETCHES}
SELECT event_id, user_id, ts FROM requests JOIN reached USING (stretch)
WHERE epoch_us(ts) // {5 * SECOND} * {5 * SECOND} + {10 * MINUTE} - 1000 + {MINUTE} <= wm"""

HOURLY_TOP = f"WITH {BEHAVIOR} " + top(windows("behavior", "item_id", HOUR, HOUR, "behavior = 'pv'"), "item_id", 5)

ORACLES: dict[str, str] = {
    "item_view_counts": f"WITH {BEHAVIOR} " + windows("behavior", "item_id", HOUR, 5 * MINUTE, "behavior = 'pv'"),
    "hot_items_topn": f"WITH {BEHAVIOR} {HOT_ITEMS}",
    "hot_items_sql": f"WITH {BEHAVIOR} {HOT_ITEMS}",
    "ranking_report": f"""
WITH {BEHAVIOR}, top AS ({HOT_ITEMS})
SELECT window_end, 'window end ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) ||
       string_agg('no ' || row_num || ': item ' || item_id || ', ' || cnt || ' views', chr(10) ORDER BY row_num)
       AS report
FROM top GROUP BY window_end""",
    "page_flow_topn": f"WITH {ACCESS} "
    + top(windows("access", "url", 10 * MINUTE, 5 * SECOND, "method = 'GET'"), "url", 3),
    "page_flow_late_aware": f"WITH {WATERMARKED} "
    + top(windows("classified", "url", 10 * MINUTE, 5 * SECOND, "method = 'GET'", FIRST_OPEN), "url", 3),
    "late_rows": f"""
WITH {WATERMARKED}
SELECT event_id, user_id, method, url, ts, make_timestamp(wm) AS watermark
FROM classified WHERE method = 'GET' AND is_late""",
    "late_rows_nulls": f"""
WITH {DELAYED},
patchy AS (SELECT event_id AS request, CASE WHEN event_id % 13 <> 0 THEN event_id END AS seq,
                  CASE WHEN event_id % 11 <> 0 THEN ts END AS ts FROM delayed),
arrived AS (
  SELECT *, CASE WHEN seq IS NOT NULL THEN
           max(CASE WHEN seq IS NOT NULL THEN epoch_us(ts) END)
             OVER (ORDER BY seq NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {3 * SECOND} END AS wm
  FROM patchy
)
SELECT request, ts, make_timestamp(wm) AS watermark,
       coalesce(epoch_us(ts) // {5 * SECOND} * {5 * SECOND} + {10 * MINUTE} - 1000 + {MINUTE} <= wm, FALSE) AS is_late
FROM arrived""",
    "page_view_hourly": hourly("count(*)"),
    "page_view_salted": hourly("count(*)"),
    "uv_exact": hourly("count(DISTINCT user_id)"),
    "uv_hashed": hourly(f"count(DISTINCT {HASH})"),
    "uv_bitmap": hourly("count(DISTINCT user_id)"),
    "uv_approx": f"SELECT *, TRUE AS near FROM ({hourly('count(DISTINCT user_id)')})",
    "value_range_sliding": f"""
SELECT event_type, make_timestamp(i * {HOUR} + {DAY}) AS window_end, min(value) AS low, max(value) AS high, count(value) AS n
FROM (SELECT event_type, value, unnest(range((epoch_us(ts) - {DAY}) // {HOUR} + 1, epoch_us(ts) // {HOUR} + 1)) AS i FROM events)
GROUP BY event_type, i""",
    "value_range_fine": f"""
SELECT event_type, make_timestamp(i * {5 * SECOND} + {HOUR}) AS window_end, min(value) AS low, max(value) AS high, count(value) AS n
FROM (
  SELECT event_type, value, unnest(range((epoch_us(ts) - {HOUR}) // {5 * SECOND} + 1, epoch_us(ts) // {5 * SECOND} + 1)) AS i
  FROM events
)
GROUP BY event_type, i""",
    "value_runner_up": """
WITH named AS (SELECT DISTINCT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, value FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, hour ORDER BY value DESC NULLS LAST) AS place FROM named),
two AS (
  SELECT event_type, hour, max(CASE WHEN place = 1 THEN value END) AS best, max(CASE WHEN place = 2 THEN value END) AS second
  FROM ranked GROUP BY event_type, hour
)
SELECT *, best - second AS lead FROM two""",
    "value_runner_up_sliding": f"""
WITH spread AS (
  SELECT DISTINCT event_type, value,
         unnest(range((epoch_us(ts) - {DAY}) // {15 * MINUTE} + 1, epoch_us(ts) // {15 * MINUTE} + 1)) AS i
  FROM events
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, i ORDER BY value DESC NULLS LAST) AS place FROM spread),
two AS (
  SELECT event_type, i, max(CASE WHEN place = 1 THEN value END) AS best, max(CASE WHEN place = 2 THEN value END) AS second
  FROM ranked GROUP BY event_type, i
)
SELECT event_type, make_timestamp(i * {15 * MINUTE} + {DAY}) AS window_end, best, second, best - second AS lead FROM two""",
    "uv_sliding_sketch": f"""
SELECT make_timestamp(i * {HOUR} + {DAY}) AS window_end, count(DISTINCT user_id) AS cnt, TRUE AS near
FROM (
  SELECT user_id, unnest(range((epoch_us(ts) - {DAY}) // {HOUR} + 1, epoch_us(ts) // {HOUR} + 1)) AS i
  FROM events WHERE event_type = 'view'
)
GROUP BY i""",
    "uv_running": running("user_id"),
    "uv_running_hashed": running(HASH),
    "marketing_by_channel": """
WITH marketing AS (
  SELECT event_type AS behavior,
         list_extract(['search', 'mail', 'partner', 'direct'], CAST(user_id % 4 AS INTEGER) + 1) AS channel, ts
  FROM events
) """
    + windows("marketing", "channel, behavior", HOUR, 5 * SECOND, "behavior IS DISTINCT FROM 'signup'"),
    "click_cap_pass": f"""
WITH {AD_CLICKS} SELECT event_id, user_id, ad_id, province, ts, day FROM ranked WHERE day_rank <= 2""",
    "click_cap_warn": f"""
WITH {AD_CLICKS}
SELECT user_id, ad_id, day, CAST(2 AS INTEGER) AS cap, ts AS first_over_ts, event_id AS first_over_seq,
       'more than 2 times on ' || strftime(day, '%Y-%m-%d') AS message
FROM ranked WHERE day_rank = 3""",
    "click_cap_outcomes": f"""
WITH {AD_CLICKS}
SELECT event_id, user_id, ad_id, province, ts, day, day_rank,
       CASE WHEN day_rank <= 2 THEN 'pass' WHEN day_rank = 3 THEN 'warn' ELSE 'drop' END AS outcome
FROM ranked""",
    "ad_by_province": f"""
WITH {AD_CLICKS}
SELECT province, window_end, cnt FROM ({windows("ranked", "province", DAY, 2 * MINUTE, "day_rank <= 2")})""",
    "fail_pairs": pairs("SELECT * FROM logins", "ts, event_id"),
    "fail_pairs_arrival": pairs(
        """SELECT event_id, user_id, event_type,
                  CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ts FROM logins""",
        "event_id",
    ),
    "fail_triples": f"""
{TRIPLES} SELECT user_id, ts2 AS first_ts, ts AS last_ts, id2 AS first_seq, event_id AS last_seq FROM hits""",
    "fail_triples_pattern": TRIPLE_PATTERN,
    "fail_bursts": BURSTS,
    "order_pay_pattern": PAY_PATTERN,
    "order_pay_outcomes": PAY_OUTCOMES,
    "pattern_followed_by_3": FOLLOWED_BY_3,
    "pattern_next_chain": NEXT_CHAIN,
    "tx_interval_join": f"""
WITH {TX}
SELECT l.tx_id, l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id, r.ts AS r_ts
FROM pays l JOIN receipts r ON {NEAR}""",
    "tx_interval_outer": INTERVAL_OUTER,
    "tx_reconcile": RECONCILE,
    "tx_reconcile_nulls": RECONCILE_PATCHY,
    "interval_join_orders": """
SELECT o_orderkey AS orderkey, o_orderdate AS orderdate, l_linenumber AS linenumber, l_shipdate AS shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
 AND l_shipdate BETWEEN o_orderdate - INTERVAL 3 DAY AND o_orderdate + INTERVAL 5 DAY""",
    "log_parse": f"""
WITH {ACCESS}
SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
       method, url FROM access""",
    "csv_round_trip": """
SELECT user_id AS order_id, ' ' || event_type || ' ' AS event_type, CASE WHEN event_type = 'purchase' THEN 'tx-' || event_id ELSE '' END AS tx_id,
       epoch_us(ts) // 1000000 AS epoch_s
FROM events""",
    "stream_hot_items": f"WITH {BEHAVIOR} {HOT_ITEMS}",
    "stream_hot_items_state": f"WITH {BEHAVIOR} {HOT_ITEMS}",
    "stream_uv_running": running("user_id"),
    "stream_page_views": hourly("count(*)"),
    "stream_order_outcomes": PAY_OUTCOMES,
    "stream_fail_bursts": BURSTS,
    "stream_hot_items_corrected": HOURLY_TOP,
    "stream_hot_items_retract": HOURLY_TOP,
    "stream_visitors": hourly("count(DISTINCT user_id)"),
    "stream_order_pay": PAY_PATTERN,
    "stream_reconcile": RECONCILE,
    "stream_reconcile_nulls": RECONCILE_PATCHY,
    "stream_interval_outer": INTERVAL_OUTER,
    "stream_late_rows": LATE_BY_STRETCH,
    "stream_windows_corrected": CORRECTED,
    "stream_fail_triples": TRIPLE_PATTERN,
    "stream_pattern_next_chain": NEXT_CHAIN,
    "stream_click_cap_clock": """
WITH clicks AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS ad_id, event_id FROM events
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id ORDER BY event_id) AS place FROM clicks)
SELECT user_id, ad_id, CASE WHEN place <= 2 THEN 'pass' WHEN place = 3 THEN 'warn' ELSE 'drop' END AS outcome,
       count(*) AS cnt, max(place) AS last_rank
FROM ranked GROUP BY ALL""",
    "stream_click_cap": f"""
WITH {AD_CLICKS}
SELECT event_id, user_id, ad_id, ts, day_rank,
       CASE WHEN day_rank <= 2 THEN 'pass' WHEN day_rank = 3 THEN 'warn' ELSE 'drop' END AS outcome
FROM ranked""",
}
