"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: plain window functions, recursive
CTEs for the sequential rules (unaligned delay, referer walk), no bucketing.
"""

from __future__ import annotations

from eventide.functions.timefmt import dur_us
from eventide.plans.catalog import PANE_SPECS, SESSION_GAP, SESSION_PANES, STATE_TTL, WINDOW
from eventide.plans.spec import PaneSpec, Trigger

ARR = "ts + to_microseconds(((event_id * 7919) % 7200) * 1000000)"
WM = f"date_trunc('hour', {ARR}) - INTERVAL 1 HOUR"
SCORE = "CAST(round(value * 100) AS BIGINT)"


def _us(d: str) -> int:
    return dur_us(d)


def _floor(col: str, size: str, offset: str = "0 seconds") -> str:
    s, o = _us(size), _us(offset)
    return f"make_timestamp(epoch_us({col}) - (((epoch_us({col}) - {o}) % {s}) + {s}) % {s})"


def _ceil(col: str, size: str, offset: str = "0 seconds") -> str:
    s, o = _us(size), _us(offset)
    r = f"((((epoch_us({col}) - {o}) % {s}) + {s}) % {s})"
    return f"make_timestamp(CASE WHEN {r} = 0 THEN epoch_us({col}) ELSE epoch_us({col}) - {r} + {s} END)"


def _plus(col: str, d: str) -> str:
    return f"({col} + to_microseconds({_us(d)}))"


LOG = f"""log AS (
  SELECT event_type AS key, {SCORE} AS score, ts AS event_ts, {ARR} AS arrival_ts, event_id AS seq, {WM} AS wm_ts
  FROM events)"""

SCORES = f"sc AS (SELECT event_type AS key, {SCORE} AS score, ts AS event_ts, event_id FROM events)"


def _fire_sql(src: str, trig: Trigger | None, limit: str, phase: int, x: str) -> tuple[list[str], str, str]:
    """(CTEs, fired SELECT, pending SELECT key, w_start, pending, n)."""
    empty_fired = f"SELECT key, w_start, w_end, {phase} AS phase, arrival_ts AS fire_ts, seq AS sub, score AS delta, false AS closing FROM {src} WHERE false"
    if trig is None or trig.kind == "watermark":
        return [], empty_fired, f"SELECT key, w_start, sum(score) AS pending, count(*) AS n FROM {src} GROUP BY key, w_start"
    if trig.kind == "count" and trig.n == 1:
        fired = f"SELECT key, w_start, w_end, {phase} AS phase, arrival_ts AS fire_ts, seq AS sub, score AS delta, false AS closing FROM {src}"
        return [], fired, f"SELECT key, w_start, 0 AS pending, 0 AS n FROM {src} WHERE false"
    if trig.kind == "aligned":
        d = _ceil("arrival_ts", trig.period, trig.offset)
        ctes = [f"""{x}_g AS (SELECT key, w_start, w_end, {limit} AS lim, d, CASE WHEN d = arrival_ts THEN 1 ELSE 0 END AS xx,
                    sum(score) AS delta, count(*) AS c
             FROM (SELECT *, {d} AS d FROM {src}) GROUP BY ALL)"""]
        cond = "(d < lim OR (d = lim AND xx = 0))"
        fired = f"SELECT key, w_start, w_end, {phase} AS phase, d AS fire_ts, xx AS sub, delta, false AS closing FROM {x}_g WHERE {cond}"
        pend = f"SELECT key, w_start, sum(delta) AS pending, sum(c) AS n FROM {x}_g WHERE NOT {cond} GROUP BY key, w_start"
        return ctes, fired, pend
    if trig.kind == "unaligned":
        dd = _us(trig.delay)
        ctes = [
            f"""{x}_s(key, w_start, s) AS (
              SELECT key, w_start, min(arrival_ts) FROM {src} GROUP BY key, w_start
              UNION ALL
              SELECT g.key, g.w_start, min(y.arrival_ts)
              FROM {x}_s g JOIN {src} y ON y.key = g.key AND y.w_start = g.w_start
                AND y.arrival_ts >= g.s + to_microseconds({dd})
              GROUP BY g.key, g.w_start)""",
            f"""{x}_p AS (SELECT y.key, y.w_start, y.w_end, y.{limit} AS lim, y.score, max(g.s) AS ps
              FROM {src} y JOIN {x}_s g ON g.key = y.key AND g.w_start = y.w_start AND g.s <= y.arrival_ts
              GROUP BY y.key, y.w_start, y.w_end, y.{limit}, y.seq, y.score)""",
            f"""{x}_g AS (SELECT key, w_start, w_end, lim, ps + to_microseconds({dd}) AS f, sum(score) AS delta
              FROM {x}_p GROUP BY ALL)""",
        ]
        fired = f"SELECT key, w_start, w_end, {phase} AS phase, f AS fire_ts, 0 AS sub, delta, false AS closing FROM {x}_g WHERE f <= lim"
        pend = f"SELECT key, w_start, sum(delta) AS pending, count(*) AS n FROM {x}_g WHERE f > lim GROUP BY key, w_start"
        return ctes, fired, pend
    raise ValueError(trig)


def count_sql(spec: PaneSpec) -> str:
    """Every n-th row of a window fires a pane; the rest fires at the close."""
    n = spec.trigger.n
    on, gc = _ceil(_plus("w_end", "1 hour"), "1 hour"), _ceil(_plus(_plus("w_end", spec.lateness), "1 hour"), "1 hour")
    return f"""WITH {LOG},
        eoi AS (SELECT date_trunc('hour', max(arrival_ts)) + INTERVAL 1 HOUR AS eoi FROM log),
        r AS (SELECT *, {_floor('event_ts', spec.size)} AS w_start, {_plus(_floor('event_ts', spec.size), spec.size)} AS w_end
              FROM log),
        k AS (SELECT key, w_start, w_end, score, arrival_ts, seq, wm_ts, least({on}, eoi) AS on_ts, least({gc}, eoi) AS gc_ts,
                (row_number() OVER (PARTITION BY key, w_start ORDER BY arrival_ts, seq) - 1) // {n} AS pane
              FROM r, eoi WHERE wm_ts < {_plus('w_end', spec.lateness)}),
        p AS (SELECT key, w_start, w_end, on_ts, gc_ts, pane, sum(score) AS delta, count(*) AS c, max(arrival_ts) AS last_ts,
                max(wm_ts) AS last_wm FROM k GROUP BY ALL),
        q AS (SELECT *, CASE WHEN c = {n} THEN CASE WHEN last_wm < w_end THEN 0 ELSE 2 END WHEN on_ts = gc_ts THEN 1 ELSE 3 END
                AS phase FROM p)
        SELECT key, w_start, w_end, pane AS pane_index,
            CASE WHEN phase > 0 THEN CAST(sum(CASE WHEN phase > 0 THEN 1 ELSE 0 END) OVER w - 1 AS BIGINT) END AS on_time_index,
            CASE phase WHEN 0 THEN 'EARLY' WHEN 1 THEN 'ON_TIME' ELSE 'LATE' END AS timing, pane = 0 AS is_first,
            phase IN (1, 3) AS is_last, CAST(sum(delta) OVER w AS BIGINT) AS value,
            CASE WHEN c = {n} THEN last_ts ELSE gc_ts END AS fire_ts
        FROM q WINDOW w AS (PARTITION BY key, w_start ORDER BY pane ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def ledger_sql(spec: PaneSpec, final: str = "panes_out") -> str:
    S, L = spec.size, spec.lateness
    early_trig = spec.early if spec.trigger.kind == "watermark" else spec.trigger
    late_trig = spec.late_trigger()
    e_ctes, e_fired, e_pend = _fire_sql("early", early_trig, "on_ts", 0, "ex")
    l_ctes, l_fired, l_pend = _fire_sql("late", late_trig, "gc_ts", 2, "lx")
    on_cond = "true" if spec.resolved_on_time() == "always" else "n > 0"
    value = "acc" if spec.mode == "accumulating" else "delta"
    ceil_on = _ceil(_plus(_plus("w_end", "0 seconds"), "1 hour"), "1 hour")
    ceil_gc = _ceil(_plus(_plus("w_end", L), "1 hour"), "1 hour")
    ctes = [LOG,
            "eoi AS (SELECT date_trunc('hour', max(arrival_ts)) + INTERVAL 1 HOUR AS eoi FROM log)",
            f"r AS (SELECT key, score, arrival_ts, seq, wm_ts, {_floor('event_ts', S)} AS w_start FROM log)",
            f"r2 AS (SELECT *, {_plus('w_start', S)} AS w_end FROM r)",
            f"""k AS (SELECT r2.*, least({ceil_on}, eoi.eoi) AS on_ts, least({ceil_gc}, eoi.eoi) AS gc_ts
                FROM r2 CROSS JOIN eoi WHERE wm_ts < {_plus('w_end', L)})""",
            "early AS (SELECT * FROM k WHERE wm_ts < w_end)",
            "late AS (SELECT * FROM k WHERE wm_ts >= w_end)",
            "steps AS (SELECT DISTINCT key, w_start, w_end, on_ts, gc_ts FROM k)",
            *e_ctes, *l_ctes,
            f"e_pend AS ({e_pend})", f"l_pend AS ({l_pend})",
            "wins_e AS (SELECT DISTINCT key, w_start, w_end, on_ts FROM early)",
            "wins_l AS (SELECT DISTINCT key, w_start, w_end, gc_ts FROM late)",
            f"""ontime AS (SELECT w.key, w.w_start, w.w_end, 1 AS phase, w.on_ts AS fire_ts, 0 AS sub,
                   COALESCE(p.pending, 0) AS delta, false AS closing, COALESCE(p.n, 0) AS n
                FROM wins_e w LEFT JOIN e_pend p ON p.key = w.key AND p.w_start = w.w_start)""",
            f"""closing AS (SELECT w.key, w.w_start, w.w_end, 2 AS phase, w.gc_ts AS fire_ts, {2**62} AS sub,
                   p.pending AS delta, true AS closing
                FROM wins_l w JOIN l_pend p ON p.key = w.key AND p.w_start = w.w_start WHERE p.n > 0)""",
            f"""panes AS ({e_fired} UNION ALL {l_fired}
                UNION ALL SELECT key, w_start, w_end, phase, fire_ts, sub, delta, closing FROM ontime WHERE {on_cond}
                UNION ALL SELECT * FROM closing)""",
            """numbered AS (SELECT p.*, s.on_ts, s.gc_ts,
                   row_number() OVER w AS idx,
                   sum(CASE WHEN p.phase > 0 THEN 1 ELSE 0 END) OVER w AS oti,
                   sum(p.delta) OVER w AS acc
                FROM panes p JOIN steps s ON s.key = p.key AND s.w_start = p.w_start
                WINDOW w AS (PARTITION BY p.key, p.w_start ORDER BY p.phase, p.fire_ts, p.sub
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
            f"""panes_out AS (SELECT key, w_start, w_end, CAST(idx - 1 AS BIGINT) AS pane_index,
                   CASE WHEN phase > 0 THEN CAST(oti - 1 AS BIGINT) END AS on_time_index,
                   CASE phase WHEN 0 THEN 'EARLY' WHEN 1 THEN 'ON_TIME' ELSE 'LATE' END AS timing,
                   idx = 1 AS is_first, (closing OR (phase = 1 AND on_ts = gc_ts)) AS is_last,
                   CAST({value} AS BIGINT) AS value, fire_ts
                FROM numbered)"""]
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"\nSELECT * FROM {final}"


def _line_sql(score: str) -> str:
    iso = "'%Y-%m-%dT%H:%M:%S.%f'"
    return (f"array_to_string(['u' || user_id, event_type, CAST({score} AS VARCHAR), strftime(ts, {iso}), "
            f"strftime({ARR}, {iso})], ',' || chr(9))")


def _window_text(s: str, e: str) -> str:
    return (f"'[' || strftime({s}, '%H:%M:%S') || ', ' || "
            f"CASE WHEN {e} IS NULL THEN 'END_OF_GLOBAL_WINDOW' ELSE strftime({e}, '%H:%M:%S') END || ')'")


def _pane_text() -> str:
    return ("printf('%s: %s:%-2d %s %-7s index=%d', " + _window_text("w_start", "w_end")
            + ", key, value, strftime(w_end - INTERVAL 1 MILLISECOND, '%H:%M:%S'), timing, pane_index)"
            " || CASE WHEN on_time_index IS NOT NULL THEN ' onTimeIndex=' || CAST(on_time_index AS VARCHAR) ELSE '' END"
            " || CASE WHEN is_first THEN ' isFirst' ELSE '' END || CASE WHEN is_last THEN ' isLast' ELSE '' END")


def _validity_sql() -> str:
    return f"""WITH {SCORES},
      per AS (SELECT key, event_ts AS w_start, sum(score) AS value FROM sc GROUP BY key, event_ts)
      SELECT key, w_start, lead(w_start) OVER (PARTITION BY key ORDER BY w_start) AS w_end, CAST(value AS BIGINT) AS value
      FROM per"""


PAGE = "event_type || '-' || CAST(CAST(least(floor(value / 20), 5) AS BIGINT) AS VARCHAR)"
SEARCH = "'q' || CAST(CAST(least(floor(value / 40), 2) AS BIGINT) AS VARCHAR)"

# Visits, impressions and goals; then, for each goal, a snapshot of the state that had arrived when it fired.
VI = f"""ev AS (SELECT CAST(user_id AS VARCHAR) AS "user", event_id, ts, event_type, value, {ARR} AS arrival_ts,
        event_id AS seq, {WM} AS wm_ts, {PAGE} AS page, {SEARCH} AS search FROM events),
    nb AS (SELECT *, lag(CASE WHEN event_type = 'signup' THEN search ELSE page END) OVER u AS prev,
        lead(page) OVER u AS nxt FROM ev WINDOW u AS (PARTITION BY "user" ORDER BY ts, event_id)),
    visits AS (SELECT "user", page AS url, ts, prev AS referer, event_type = 'purchase' AS is_goal, arrival_ts, seq, wm_ts
      FROM nb WHERE event_type <> 'signup'),
    imps AS (SELECT "user", event_id AS id, search AS source_url, nxt AS target_url, ts, arrival_ts, seq, wm_ts
      FROM nb WHERE event_type = 'signup'),
    goals AS (SELECT "user", url AS goal_url, ts AS goal_ts, arg_min(referer, (arrival_ts, seq)) AS goal_referer,
        min(arrival_ts) AS g_arr, arg_min(seq, (arrival_ts, seq)) AS g_seq, min(wm_ts) AS g_wm
      FROM visits WHERE is_goal GROUP BY "user", url, ts)"""


def _walks(ttl: str | None = None, stop: bool = True) -> str:
    seen = ("CASE WHEN g.g_wm >= g.goal_ts THEN (s.arrival_ts, s.seq) < (g.g_arr, g.g_seq) ELSE s.wm_ts < g.goal_ts END")
    fresh = f" AND s.ts + to_microseconds({_us(ttl)}) >= greatest(g.goal_ts, g.g_wm)" if ttl else ""
    go_on = "AND i.id IS NULL" if stop else ""
    return f"""{VI},
    gv AS (SELECT g."user", g.goal_url, g.goal_ts, s.url, arg_max(s.ts, (s.arrival_ts, s.seq)) AS ts,
        arg_max({{'r': s.referer}}, (s.arrival_ts, s.seq)).r AS referer
      FROM goals g JOIN visits s ON s."user" = g."user" AND NOT s.is_goal AND {seen}
      GROUP BY g."user", g.goal_url, g.goal_ts, s.url),
    gv2 AS (SELECT s.* FROM gv s JOIN goals g USING ("user", goal_url, goal_ts) WHERE true{fresh}),
    gi AS (SELECT g."user", g.goal_url, g.goal_ts, s.source_url, s.target_url, arg_min(s.id, (s.arrival_ts, s.seq)) AS id,
        arg_min(s.ts, (s.arrival_ts, s.seq)) AS ts
      FROM goals g JOIN imps s ON s."user" = g."user" AND {seen}
      GROUP BY g."user", g.goal_url, g.goal_ts, s.source_url, s.target_url),
    gi2 AS (SELECT s.* FROM gi s JOIN goals g USING ("user", goal_url, goal_ts) WHERE true{fresh}),
    walk("user", goal_url, goal_ts, cur_url, cur_ref, trail, times, depth) AS (
      SELECT "user", goal_url, goal_ts, goal_url, goal_referer, CAST([] AS VARCHAR[]), CAST([] AS TIMESTAMP[]), 0 FROM goals
      UNION ALL
      SELECT w."user", w.goal_url, w.goal_ts, v.url, v.referer, list_prepend(v.url, w.trail), list_prepend(v.ts, w.times),
        w.depth + 1
      FROM walk w JOIN gv2 v ON v."user" = w."user" AND v.goal_url = w.goal_url AND v.goal_ts = w.goal_ts AND v.url = w.cur_ref
        LEFT JOIN gi2 i ON i."user" = w."user" AND i.goal_url = w.goal_url AND i.goal_ts = w.goal_ts
          AND i.source_url = w.cur_ref AND i.target_url = w.cur_url
      WHERE NOT list_contains(w.trail, v.url) AND v.url <> w.goal_url {go_on}),
    hits AS (SELECT w."user", w.goal_url, w.goal_ts, w.depth, i.id AS imp_id, w.cur_ref AS source_url,
        w.cur_url AS target_url, w.trail, w.times
      FROM walk w JOIN gi2 i ON i."user" = w."user" AND i.goal_url = w.goal_url AND i.goal_ts = w.goal_ts
        AND i.source_url = w.cur_ref AND i.target_url = w.cur_url)"""


PATH = "array_to_string([source_url] || trail || [goal_url], ' → ')"

# Goals one after another in firing order per user; each takes the first impression of its walk not yet taken.
ONCE = """turns AS (SELECT "user", goal_url, goal_ts, row_number() OVER (PARTITION BY "user" ORDER BY greatest(goal_ts, g_wm),
        g_wm >= goal_ts, CASE WHEN g_wm >= goal_ts THEN g_arr END, CASE WHEN g_wm >= goal_ts THEN g_seq END, goal_ts, goal_url)
        AS turn FROM goals),
    ways AS (SELECT t."user", t.turn, t.goal_url, t.goal_ts, list({'d': h.depth, 'k': h.source_url || ' ' || h.target_url,
        'id': h.imp_id} ORDER BY h.depth) FILTER (h.depth IS NOT NULL) AS way
      FROM turns t LEFT JOIN hits h USING ("user", goal_url, goal_ts) GROUP BY ALL),
    run("user", turn, taken, got) AS (
      SELECT DISTINCT "user", CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST(NULL AS STRUCT(d INTEGER, k VARCHAR, id BIGINT))
      FROM turns
      UNION ALL
      SELECT r."user", w.turn, CASE WHEN f IS NULL THEN r.taken ELSE list_append(r.taken, f.k) END, f
      FROM run r JOIN (SELECT * FROM ways) w ON w."user" = r."user" AND w.turn = r.turn + 1,
        LATERAL (SELECT list_filter(coalesce(w.way, []), lambda x: NOT list_contains(r.taken, x.k))[1] AS f) z)"""


def session_panes_sql(gap: str, early_delay: str, lateness: str) -> str:
    """Session panes by replay: one recursion step a row of a key, the open sessions as a list."""
    g, d, late, hour = _us(gap), _us(early_delay), _us(lateness), 3_600_000_000
    # The processing time at which the watermark reaches a level: one hour later, at a whole hour, or the end of input.
    step = lambda level: f"least((({level} + {2 * hour - 1}) // {hour}) * {hour}, eoi)"
    session = "STRUCT(s BIGINT, e BIGINT, total BIGINT, due BIGINT, idx BIGINT, oti BIGINT, done BOOLEAN)"
    pane = "STRUCT(s BIGINT, e BIGINT, idx BIGINT, oti BIGINT, timing VARCHAR, \"last\" BOOLEAN, value BIGINT, fired BIGINT)"
    moved = f"""list_transform(st, lambda x: {{'x': x, 'steps': {step('x.e')}, 'gone': {step(f'x.e + {late}')},
            'early': coalesce(x.due <= least(now, {step('x.e')}), false), 'on': NOT x.done AND {step('x.e')} <= now}})"""
    fired = """list_concat(
            list_transform(list_filter(m, lambda y: y.early), lambda y: {'s': y.x.s, 'e': y.x.e, 'idx': y.x.idx,
              'oti': NULL::BIGINT, 'timing': 'EARLY', 'last': false, 'value': y.x.total, 'fired': y.x.due}),
            list_transform(list_filter(m, lambda y: y.on), lambda y: {'s': y.x.s, 'e': y.x.e, 'idx': y.x.idx + y.early::BIGINT,
              'oti': y.x.oti, 'timing': 'ON_TIME', 'last': y.gone <= y.steps, 'value': y.x.total, 'fired': y.steps}))"""
    left = """list_transform(list_filter(m, lambda y: y.gone > now), lambda y: {'s': y.x.s, 'e': y.x.e, 'total': y.x.total,
            'due': CASE WHEN y.early OR y.on THEN NULL ELSE y.x.due END, 'idx': y.x.idx + y.early::BIGINT + y.on::BIGINT,
            'oti': y.x.oti + y.on::BIGINT, 'done': y.x.done OR y.on})"""
    return f"""WITH RECURSIVE {LOG},
      eoi AS (SELECT epoch_us(date_trunc('hour', max(arrival_ts)) + INTERVAL 1 HOUR) AS eoi FROM log),
      r AS (SELECT key, score, epoch_us(event_ts) AS t, epoch_us(arrival_ts) AS now, epoch_us(wm_ts) AS wm, eoi,
              row_number() OVER (PARTITION BY key ORDER BY arrival_ts, seq) AS rn FROM log, eoi),
      run(key, rn, st, panes) AS (
        SELECT DISTINCT key, 0::BIGINT, CAST([] AS {session}[]), CAST([] AS {pane}[]) FROM r
        UNION ALL
        SELECT key, rn, CAST(CASE WHEN dropped THEN st ELSE list_append(apart, {{'s': s, 'e': e, 'total': total,
            'due': CASE WHEN late THEN NULL ELSE coalesce(due, now + {d}) END, 'idx': idx + late::BIGINT, 'oti': oti + late::BIGINT,
            'done': late}}) END AS {session}[]),
          CAST(CASE WHEN late AND NOT dropped THEN list_append(panes, {{'s': s, 'e': e, 'idx': idx, 'oti': oti, 'timing': 'LATE',
            'last': false, 'value': total, 'fired': now}}) ELSE panes END AS {pane}[])
        FROM (SELECT *, wm >= e AS late, CASE WHEN same THEN p[1].idx ELSE 0 END AS idx, CASE WHEN same THEN p[1].oti ELSE 0 END AS oti
        FROM (SELECT *, least(t, list_min(list_transform(p, lambda x: x.s))) AS s,
            greatest(t + {g}, list_max(list_transform(p, lambda x: x.e))) AS e, list_min(list_transform(p, lambda x: x.due)) AS due,
            score + coalesce(list_sum(list_transform(p, lambda x: x.total)), 0)::BIGINT AS total,
            coalesce(len(p) = 1 AND p[1].s <= t AND t + {g} <= p[1].e, false) AS same
        FROM (SELECT *, list_filter(st, lambda x: x.s < t + {g} AND t < x.e) AS p,
            list_filter(st, lambda x: NOT (x.s < t + {g} AND t < x.e)) AS apart, wm >= t + {g + late} AS dropped
        FROM (SELECT key, rn, score, t, now, wm, {fired} AS panes, {left} AS st
        FROM (SELECT r.key, r.rn, r.score, r.t, r.now, r.wm, {moved} AS m
              FROM run JOIN r ON r.key = run.key AND r.rn = run.rn + 1))))) ),
      rest AS (SELECT key, {moved} AS m FROM (SELECT key, arg_max(st, rn) AS st, eoi AS now, eoi FROM run, eoi GROUP BY key, eoi)),
      out AS (SELECT key, unnest(panes) AS p FROM run UNION ALL SELECT key, unnest(CAST({fired} AS {pane}[])) FROM rest)
      SELECT key, make_timestamp(p.s) AS w_start, make_timestamp(p.e) AS w_end, p.idx AS pane_index, p.oti AS on_time_index,
        p.timing AS timing, p.idx = 0 AS is_first, p."last" AS is_last, p.value AS value, make_timestamp(p.fired) AS fire_ts FROM out"""


def oracle_sql() -> dict[str, str]:
    gap = _us(SESSION_GAP)
    o = {
        "fixed_window_sum": f"""WITH {SCORES}
            SELECT key, {_floor('event_ts', WINDOW)} AS w_start, {_plus(_floor('event_ts', WINDOW), WINDOW)} AS w_end,
                   CAST(sum(score) AS BIGINT) AS value FROM sc GROUP BY ALL""",
        "sum_per_key": f"WITH {SCORES} SELECT key, CAST(sum(score) AS BIGINT) AS value FROM sc GROUP BY key",
        "session_sum": f"""WITH {SCORES},
            a AS (SELECT *, lag(event_ts) OVER (PARTITION BY key ORDER BY event_ts, event_id) AS prev FROM sc),
            b AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(event_ts) - epoch_us(prev) >= {gap} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY key ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
                  FROM a)
            SELECT key, min(event_ts) AS w_start, max(event_ts) + to_microseconds({gap}) AS w_end,
                   CAST(sum(score) AS BIGINT) AS value FROM b GROUP BY key, sid""",
        "validity_windows": _validity_sql(),
        "session_panes": session_panes_sql(**SESSION_PANES),
        "parse_scores": f"""SELECT 'u' || user_id AS "user", event_type AS team, {SCORE} AS score, ts AS event_ts,
                                   {ARR} AS arrival_ts FROM events WHERE event_id % 40 > 2""",
        "score_rejects": f"""SELECT CASE event_id % 40 WHEN 0 THEN 'u' || user_id || ',' || chr(9) || event_type WHEN 1 THEN ''
                ELSE {_line_sql("'x' || " + SCORE)} END AS value FROM events WHERE event_id % 40 <= 2""",
        "write_text": f"SELECT {_line_sql(SCORE)} AS value FROM events",
        "scan_text": f"""WITH {SCORES}, w AS (SELECT key, {_floor('event_ts', WINDOW)} AS w_start,
                {_plus(_floor('event_ts', WINDOW), WINDOW)} AS w_end, sum(score) AS v FROM sc GROUP BY ALL)
            SELECT key || ' ' || {_window_text('w_start', 'w_end')} || ' ' || CAST(CAST(v AS BIGINT) AS VARCHAR) AS value FROM w""",
        "parse_time": """SELECT event_id, strftime(ts, '%H:%M:%S') AS hms,
                                CAST('1970-01-01 ' || strftime(ts, '%H:%M:%S') AS TIMESTAMP) AS t FROM events""",
        "format_time": """SELECT event_id, CASE event_id % 50 WHEN 0 THEN 'null' WHEN 1 THEN 'TIMESTAMP_MIN_VALUE'
                WHEN 2 THEN 'TIMESTAMP_MAX_VALUE' WHEN 3 THEN 'END_OF_GLOBAL_WINDOW' ELSE strftime(ts, '%H:%M:%S') END AS text
            FROM events""",
        "format_window": f"""SELECT key, w_start, CASE (epoch_us(w_start) // 1000000) % 20 WHEN 0 THEN '[global window]'
                WHEN 1 THEN '..., ' || strftime(w_start, '%H:%M:%S') || ']'
                ELSE {_window_text('w_start', 'w_end')} END AS text FROM ({_validity_sql()})""",
        "format_pane": ledger_sql(PANE_SPECS["allowed_lateness"]).replace(
            "SELECT * FROM panes_out", f"SELECT key, w_start, pane_index, {_pane_text()} AS text FROM panes_out"),
        "arrival_log": f"WITH {LOG} SELECT * FROM log",
        "dropped_late": ledger_sql(PANE_SPECS["on_time_panes"]).replace(
            "SELECT * FROM panes_out",
            "SELECT key, w_start, seq, arrival_ts, score FROM r2 WHERE wm_ts >= w_end"),
        "visits_or_impressions": f"""WITH {VI}
            SELECT "user", seq, 'visit' AS kind, url, referer, ts, is_goal, CAST(NULL AS BIGINT) AS imp_id FROM visits
            UNION ALL
            SELECT "user", seq, 'impression', target_url, source_url, ts, CAST(NULL AS BOOLEAN), id FROM imps""",
        "latest_visit": f"""WITH {VI} SELECT "user", url, arg_max(ts, (arrival_ts, seq)) AS ts,
            arg_max({{'r': referer}}, (arrival_ts, seq)).r AS referer, arg_max(seq, (arrival_ts, seq)) AS seq
            FROM visits WHERE NOT is_goal GROUP BY "user", url""",
        "dedup_impressions": f"""WITH {VI} SELECT "user", source_url, target_url, arg_min(id, (arrival_ts, seq)) AS id,
            arg_min(ts, (arrival_ts, seq)) AS ts FROM imps GROUP BY "user", source_url, target_url""",
        "referer_chain": f"""WITH RECURSIVE {_walks()} SELECT "user", goal_url, goal_ts, depth, cur_url, cur_ref FROM walk""",
        "attribution": f"""WITH RECURSIVE {_walks()}
            SELECT "user", goal_url, goal_ts, imp_id, source_url, {PATH} AS path,
                   array_to_string(list_transform(times, lambda t: strftime(t, '%m-%d %H:%M:%S')), ' ') AS visit_times,
                   CAST(len(trail) AS BIGINT) AS trail_len
            FROM hits""",
        "attribution_once": f"""WITH RECURSIVE {_walks(STATE_TTL, stop=False)}, {ONCE}
            SELECT t."user", t.goal_url, t.goal_ts, r.got.id AS imp_id, CAST(r.got.d AS BIGINT) AS trail_len
            FROM run r JOIN turns t ON t."user" = r."user" AND t.turn = r.turn WHERE r.got IS NOT NULL""",
        "format_attribution": f"""WITH RECURSIVE {_walks()},
            f AS (SELECT *, printf('[global window]: imp=%s %s %s ', CAST(imp_id AS VARCHAR), {PATH},
                          strftime(goal_ts, '%H:%M:%S')) AS head FROM hits)
            SELECT "user", goal_url, goal_ts, head || 'UNKNOWN' AS text,
                   head || 'LATE    index=1 onTimeIndex=0 isLast' AS pane_text FROM f""",
    }
    for name, spec in PANE_SPECS.items():
        sql = count_sql(spec) if spec.trigger.kind == "count" and spec.trigger.n > 1 else ledger_sql(spec)
        if name == "pane_metadata":
            sql = sql.replace("SELECT * FROM panes_out", f"SELECT *, {_pane_text()} AS text FROM panes_out")
        o[name] = sql
    # Every third event without a key: a stand-in while the query runs, since SQL joins leave nulls out.
    for name, sql in (("null_key_panes", o["accumulating_panes"]), ("null_key_session_panes", o["session_panes"])):
        marked = sql.replace("SELECT event_type AS key,", "SELECT CASE WHEN event_id % 3 = 0 THEN '~' ELSE event_type END AS key,", 1)
        o[name] = f"SELECT * REPLACE (nullif(key, '~') AS key) FROM ({marked})"
    return o
