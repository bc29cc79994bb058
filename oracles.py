"""SQL equivalents of the registered queries, for DuckDB over the driver's tables.

Written another way on purpose: one row per record, joins of a person's events
with each other, and a recursive walk that carries the accepted outcomes. The
engine does none of these.
"""

from __future__ import annotations

# Fixed values, stated here again so that a wrong one in the engine shows.
TARGETS = ("LB", "SB", "ECT", "AB", "SA", "DELIV")
OUTCOMES = ("LB", "SB", "DELIV", "TRO", "ECT", "AB", "SA")
EXTRA_CANDIDATES = {
    "LB": (),
    "SB": ("AGP", "PCONF"),
    "ECT": ("AGP", "PCONF", "ECT_SURG1", "ECT_SURG2", "MTX"),
    "AB": ("AGP", "PCONF"),
    "SA": ("AGP", "PCONF"),
    "DELIV": ("AGP", "PCONF"),
}
OUTCOME_CONCEPTS = {"LB": 4092289, "DELIV": 4092289, "SA": 4067106, "SB": 4067106, "AB": 4081422, "ECT": 4081422}
# Least days to an outcome (in the order of OUTCOMES) after the one named.
MIN_DAYS = {
    "LB": (182, 168, 168, 70, 70, 70, 70),
    "SB": (182, 168, 168, 70, 70, 70, 70),
    "DELIV": (182, 168, 168, 70, 70, 70, 70),
    "TRO": (168, 154, 154, 730, 56, 56, 365),
    "ECT": (168, 154, 154, 365, 56, 56, 56),
    "AB": (168, 154, 154, 365, 56, 56, 56),
    "SA": (168, 154, 154, 365, 56, 56, 56),
}
# Longest and shortest term, days to the next conception.
TERM_ROWS = """
('LB', 301, 161, 28), ('SB', 301, 100, 28), ('DELIV', 301, 140, 28), ('TRO', 365, 42, 14),
('ECT', 84, 42, 14), ('AB', 168, 42, 14), ('SA', 139, 28, 14)
"""
# Assumed days of a preterm and a full-term pregnancy, and without a remark.
LENGTH_ROWS = """
('LB', 245, 280, 280), ('SB', 196, 280, 196), ('DELIV', 245, 280, 280), ('TRO', 56, 56, 56),
('ECT', 56, 56, 56), ('AB', 70, 70, 70), ('SA', 70, 70, 70)
"""
# The code set of FIXTURES.md: concepts 0 to 31, and drugs.
CONCEPT_CATEGORIES = (
    "LB LB DELIV DELIV SB AB AB SA SA ECT TRO AGP PCONF PCOMP TA ECT_SURG1 ECT_SURG2 LMP LMP "
    "GEST GEST GEST OVUL OVUL2 NULS AFP AMEN UP PREM POSTT FT DIAB"
).split()
DRUG_CONCEPTS = {101: "CONTRA", 102: "MTX", 103: "OVULDR"}


def _codes() -> str:
    weeks = {19: "30", 20: "45"}
    rows = [
        f"({i}, '{c}', {weeks.get(i, 'NULL')}, '{'R' if c == 'FT' else 'N/A'}')"
        for i, c in enumerate(CONCEPT_CATEGORIES)
    ]
    rows += [f"({i}, '{c}', NULL, 'N/A')" for i, c in DRUG_CONCEPTS.items()]
    return ", ".join(rows)


def _quoted(names) -> str:
    return ", ".join(f"'{name}'" for name in names)


INPUTS = f"""
facts AS MATERIALIZED (
  SELECT o.o_custkey AS person_id, CAST(l.l_shipdate AS DATE) AS d,
         CAST(CASE WHEN o.o_custkey % 50 = 7 THEN 31 ELSE l.l_partkey % 40 END AS INTEGER) AS concept_id,
         (l.l_orderkey * 7 + l.l_linenumber) % 10 AS dom,
         l.l_returnflag AS flag, CAST(l.l_quantity AS INTEGER) AS qty, l.l_partkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
pregnancy_concepts AS (
  SELECT * FROM (VALUES {_codes()}) AS t(concept_id, category, gest_value, data_value)
),
concept AS (
  SELECT CAST(i AS INTEGER) AS concept_id,
         CASE WHEN i = 1040 THEN 'Dose Form' WHEN i % 2 = 0 THEN 'Ingredient' ELSE 'Clinical Drug' END AS concept_class_id
  FROM range(1000, 1041) AS r(i)
),
concept_ancestor AS (
  SELECT 101 AS ancestor_concept_id, CAST(1000 + x AS INTEGER) AS descendant_concept_id FROM range(0, 40) AS r(x) WHERE x % 4 = 0
  UNION ALL SELECT 102, CAST(1000 + x AS INTEGER) FROM range(0, 40) AS r(x) WHERE x % 4 = 1
  UNION ALL SELECT 103, CAST(1000 + x AS INTEGER) FROM range(0, 40) AS r(x) WHERE x % 8 = 2
  UNION ALL SELECT 101, CAST(1000 + x AS INTEGER) FROM range(0, 40) AS r(x) WHERE x % 8 = 1
  UNION ALL SELECT 102, 1040
),
person AS (
  SELECT c_custkey AS person_id, CASE WHEN c_custkey % 10 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
         1940 + (c_custkey * 7) % 50 AS year_of_birth
  FROM customer
),
period_starts AS (
  SELECT c_custkey, DATE '1995-01-01' + CAST((c_custkey * 13) % 200 AS INTEGER) AS s FROM customer
),
observation_period AS (
  SELECT c_custkey AS person_id, s AS observation_period_start_date,
         CASE WHEN c_custkey % 3 = 0 THEN DATE '1998-06-30' ELSE DATE '2001-12-31' END AS observation_period_end_date
  FROM period_starts
  UNION ALL
  SELECT c_custkey, DATE '1998-07-15', DATE '2001-12-31' FROM period_starts WHERE c_custkey % 3 = 0
)"""

RAW = INPUTS + """,
raw_events AS MATERIALIZED (
  SELECT c.category, c.gest_value, f.person_id, f.d AS start_date,
         CASE WHEN dom < 4 THEN 'Cond' WHEN dom < 6 THEN 'Proc' WHEN dom = 6 THEN 'Obs' ELSE 'Meas' END AS type,
         CASE WHEN dom < 6 THEN ' ' ELSE flag END AS value_as_string,
         CASE WHEN dom >= 6 AND qty % 3 = 0 THEN qty + qty % 2 * 0.1 END AS value_as_number
  FROM facts f JOIN pregnancy_concepts c USING (concept_id)
  WHERE dom < 8 AND (dom < 6 OR c.data_value IN ('N/A', flag))
),
glucose_only AS (
  SELECT person_id, count(*) AS n_records FROM raw_events
  GROUP BY person_id HAVING count(DISTINCT category) = 1 AND max(category) = 'DIAB'
)"""

EVENTS = RAW + """,
nondrug AS MATERIALIZED (
  SELECT person_id, category, start_date, gest_value FROM (
    SELECT * EXCLUDE (gest_value), if(category = 'GEST', 7 * coalesce(value_as_number, gest_value), NULL) AS gest_value
    FROM raw_events ANTI JOIN glucose_only USING (person_id)
  ) WHERE category <> 'GEST' OR gest_value <= 301
),
drug_concepts AS (
  SELECT a.descendant_concept_id AS concept_id, p.category, p.gest_value
  FROM concept_ancestor a JOIN pregnancy_concepts p ON p.concept_id = a.ancestor_concept_id
  SEMI JOIN (SELECT * FROM concept WHERE concept_class_id <> 'Dose Form') c ON c.concept_id = a.descendant_concept_id
),
drugs AS (
  SELECT f.person_id, dc.category, f.d AS start_date, dc.gest_value
  FROM facts f JOIN drug_concepts dc ON dc.concept_id = 1000 + f.l_partkey % 40
  SEMI JOIN nondrug n ON n.person_id = f.person_id
  WHERE f.dom >= 8
),
pregnancy_events AS MATERIALIZED (
  SELECT person_id,
         row_number() OVER (PARTITION BY person_id ORDER BY start_date, category, gest_value NULLS FIRST) AS event_id,
         category, start_date AS event_date, gest_value
  FROM (SELECT * FROM nondrug UNION ALL SELECT * FROM drugs)
)"""


def _candidates() -> str:
    parts = []
    for target in TARGETS:
        categories = _quoted((*OUTCOMES, *EXTRA_CANDIDATES[target]))
        parts.append(
            f"SELECT '{target}' AS target, person_id, min(event_id) AS event_id, category, event_date, gest_value "
            f"FROM pregnancy_events WHERE category IN ({categories}) "
            f"AND person_id IN (SELECT person_id FROM pregnancy_events WHERE category = '{target}') "
            "GROUP BY person_id, category, event_date, gest_value"
        )
    return "candidates AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"


def _move(name: str, source: str, category: str, by: tuple[str, ...]) -> str:
    """Events after the candidates of one category moved within 14 days."""
    return f"""
{name}_moves AS (
  SELECT c.person_id, c.event_id, max(s.event_date) AS revised
  FROM candidates c JOIN {source} s ON s.person_id = c.person_id AND s.category IN ({_quoted(by)})
    AND s.event_date - c.event_date BETWEEN 0 AND 14
  WHERE c.target = '{category}' AND c.category = '{category}'
  GROUP BY c.person_id, c.event_id
),
{name} AS MATERIALIZED (
  SELECT e.person_id, e.event_id, e.category, coalesce(m.revised, e.event_date) AS event_date, e.gest_value
  FROM {source} e LEFT JOIN {name}_moves m ON m.person_id = e.person_id AND m.event_id = e.event_id
)"""


MOVED = (
    EVENTS
    + ",\n"
    + _candidates()
    + ","
    + _move("after_ect", "pregnancy_events", "ECT", ("ECT_SURG1", "MTX"))
    + ","
    + _move("after_ab", "after_ect", "AB", ("SA", "AB"))
    + ","
    + _move("moved", "after_ab", "SA", ("SA", "AB"))
    + """,
targets AS MATERIALIZED (
  SELECT c.person_id, c.event_id, c.category, c.event_date AS first_date, m.event_date
  FROM candidates c JOIN moved m ON m.person_id = c.person_id AND m.event_id = c.event_id
  WHERE c.category = c.target
),
care AS (SELECT person_id, event_date FROM pregnancy_events WHERE category IN ('AGP', 'PCONF')),
proven AS (
  SELECT DISTINCT t.person_id, t.event_id FROM targets t
  JOIN pregnancy_events s ON s.person_id = t.person_id AND s.category IN ('ECT_SURG1', 'ECT_SURG2', 'MTX')
    AND s.event_date - t.first_date BETWEEN 0 AND 14
  WHERE t.category = 'ECT'
),
cared_before AS (
  SELECT DISTINCT t.person_id, t.event_id FROM targets t
  JOIN care s ON s.person_id = t.person_id AND t.event_date - s.event_date BETWEEN 0 AND 41
),
cared_after AS (
  SELECT DISTINCT t.person_id, t.event_id FROM targets t
  JOIN care s ON s.person_id = t.person_id AND s.event_date - t.event_date BETWEEN 1 AND 42
)"""
)

_LIMITS = (
    "MAP {" + ", ".join(f"'{a}>{b}': {days}" for a, row in MIN_DAYS.items() for b, days in zip(OUTCOMES, row)) + "}"
)


def _accept(forward: bool, veto: str, targets: tuple[str, ...] = TARGETS) -> str:
    order = " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TARGETS))
    # as written, a birth is taken out by the days from it back to the one accepted, which come with their sign
    same_births = "" if forward else f"OR (a.category = 'LB' AND q.category = 'LB' AND (a.event_date - q.event_date) + 1 < {_LIMITS}['LB>LB'])"
    return MOVED + f""",
queue AS MATERIALIZED (
  SELECT *, row_number() OVER (
      PARTITION BY person_id ORDER BY CASE category {order} END, first_date, event_id) AS turn
  FROM targets t
  WHERE category IN ({_quoted(targets)})
    AND (category = 'LB'
      OR (category = 'SB' AND (person_id, event_id) NOT IN (SELECT person_id, event_id FROM {veto}))
      OR (category IN ('AB', 'SA', 'DELIV', 'ECT')
          AND (person_id, event_id) NOT IN (SELECT person_id, event_id FROM cared_after)
          AND (category <> 'ECT' OR (person_id, event_id) IN (SELECT person_id, event_id FROM proven))))
),
walk AS (
  SELECT person_id, CAST(1 AS BIGINT) AS turn,
         [{{'event_id': event_id, 'category': category, 'event_date': event_date}}] AS accepted
  FROM queue WHERE turn = 1
  UNION ALL
  SELECT w.person_id, q.turn,
         CASE WHEN len(list_filter(w.accepted, lambda a:
             CASE WHEN a.event_date <= q.event_date
                  THEN abs((q.event_date - a.event_date) + 1) < {_LIMITS}[a.category || '>' || q.category]
                  ELSE abs((q.event_date - a.event_date) + 1) < {_LIMITS}[q.category || '>' || a.category] END
             {same_births})) > 0
         THEN w.accepted
         ELSE list_append(w.accepted, {{'event_id': q.event_id, 'category': q.category, 'event_date': q.event_date}}) END
  FROM walk w JOIN queue q ON q.person_id = w.person_id AND q.turn = w.turn + 1
),
accepted AS MATERIALIZED (
  SELECT person_id, unnest(accepted, recursive := true)
  FROM (SELECT person_id, arg_max(accepted, turn) AS accepted FROM walk GROUP BY person_id)
)"""


OUTCOME_ROWS = f""",
term_durations AS (
  SELECT * FROM (VALUES {TERM_ROWS}) AS t(category, max_term, min_term, retry)
),
gest_est AS (
  SELECT * FROM (VALUES {LENGTH_ROWS}) AS t(category, preterm, fullterm, nodata)
),
prior AS MATERIALIZED (
  SELECT o.person_id, o.event_id, p.event_date AS prior_date, p.category AS prior_category
  FROM accepted o ASOF LEFT JOIN accepted p ON p.person_id = o.person_id AND o.event_date > p.event_date
)"""


# Where a weak start moves, by the order of first care, end of contraception and the start itself: care against the start, contraception
# against the start, care against contraception (-1 before, 0 the same day, 1 after, 9 unknown). In all other orders it stays.
_MOVES = """
(-1, 9, 9, 'care'), (9, 1, 9, 'pill'),
(-1, -1, 1, 'care'), (-1, -1, -1, 'pill'), (-1, 0, -1, 'pill'), (-1, 1, -1, 'pill'),
(1, 1, -1, 'pill'), (1, 1, 0, 'pill'), (1, 1, 1, 'pill')
"""

# Rule, rank, evidence and the days from a start to its evidence.
_RULES = (
    ("LMP", 1, ("LMP",), 0),
    ("GEST", 2, ("GEST",), 0),
    ("OVUL", 3, ("OVUL",), 13),
    ("OVUL2", 4, ("OVUL2",), 13),
    ("NULS", 6, ("NULS",), 89),
    ("AFP", 7, ("AFP",), 123),
    ("AMEN", 80, ("AMEN",), 55),
    ("UP", 90, ("UP",), 55),
    ("PUSHBACK", None, ("PCONF", "AGP", "PCOMP", "TA"), 55),
    ("CONTRA", None, ("CONTRA",), 0),
)


def _starts(own_prior: bool) -> str:
    rules = ", ".join(
        f"('{name}', {rank or 'NULL'}, '{category}', {days})"
        for name, rank, categories, days in _RULES
        for category in categories
    )
    if own_prior:
        lender = "SELECT person_id, event_id, prior_date, true AS lent FROM prior"
        borrow = "b.person_id = o.person_id AND b.event_id = o.event_id"
    else:
        lender = "SELECT person_id, event_id, prior_date, true AS lent FROM prior WHERE person_id = event_id"
        borrow = "b.event_id = o.event_id"
    return (
        OUTCOME_ROWS
        + f""",
rules AS (SELECT * FROM (VALUES {rules}) AS t(rule, rank, category, days)),
lender AS ({lender}),
spans AS MATERIALIZED (
  SELECT o.person_id, o.event_id, o.event_date - t.min_term AS last_start, b.lent,
         greatest(o.event_date - t.max_term, w.prior_date + t.retry) AS first_start,
         greatest(o.event_date - t.max_term, b.prior_date + t.retry) AS first_lent
  FROM accepted o
  JOIN term_durations t USING (category)
  JOIN prior w ON w.person_id = o.person_id AND w.event_id = o.event_id
  LEFT JOIN lender b ON {borrow}
),
signs AS MATERIALIZED (
  SELECT m.person_id, r.rule, r.rank, m.event_date,
         CAST(m.event_date AS TIMESTAMP) - to_microseconds(CAST(round(86400000000 *
           if(r.rule = 'GEST', CAST(m.gest_value AS DOUBLE) - 1, r.days)) AS BIGINT)) AS start
  FROM moved m JOIN rules r USING (category)
),
found AS MATERIALIZED (
  SELECT s.person_id, s.event_id, g.rule, g.rank,
         CAST(if(g.rule IN ('LMP', 'CONTRA', 'GEST'), arg_max(g.start, (g.event_date, g.start)), min(g.start)) AS DATE)
           AS episode_start_date
  FROM spans s JOIN signs g ON g.person_id = s.person_id AND g.start <= s.last_start
  WHERE if(g.rule = 'OVUL2', s.lent AND g.start >= s.first_lent, g.start >= s.first_start)
  GROUP BY s.person_id, s.event_id, g.rule, g.rank
),
remarks AS (
  SELECT o.person_id, o.event_id, o.event_date, o.category, w.prior_date, w.prior_category,
         coalesce(bool_or(m.category = 'PREM'), false) AS early, coalesce(bool_or(m.category = 'FT'), false) AS full
  FROM accepted o
  JOIN prior w ON w.person_id = o.person_id AND w.event_id = o.event_id
  JOIN term_durations t ON t.category = o.category
  LEFT JOIN moved m ON m.person_id = o.person_id AND m.category IN ('PREM', 'FT')
    AND m.event_date <= o.event_date + 30
    AND m.event_date >= greatest(o.event_date - t.max_term, w.prior_date)
  GROUP BY ALL
),
assumed AS MATERIALIZED (
  SELECT r.person_id, r.event_id, if(r.early, 'PREM', 'DEFAULT') AS start_category,
         greatest(r.event_date - if(r.early, g.preterm, if(r.full, g.fullterm, g.nodata)), r.prior_date + t.retry)
           AS episode_start_date
  FROM remarks r JOIN gest_est g ON g.category = r.category
  LEFT JOIN term_durations t ON t.category = r.prior_category
),
all_starts AS MATERIALIZED (
  SELECT person_id, event_id, episode_start_date, rule AS start_category, CAST(rank AS INTEGER) AS date_rank
  FROM found WHERE rank IS NOT NULL
  UNION ALL
  SELECT person_id, event_id, episode_start_date, start_category, 99 FROM assumed
),
best AS MATERIALIZED (
  SELECT person_id, event_id, arg_min(episode_start_date, date_rank) AS episode_start_date,
         arg_min(start_category, date_rank) AS start_category, min(date_rank) AS date_rank
  FROM all_starts GROUP BY person_id, event_id
),
hints AS (
  SELECT person_id, event_id, max(episode_start_date) FILTER (WHERE rule = 'PUSHBACK') AS care,
         max(episode_start_date) FILTER (WHERE rule = 'CONTRA') AS pill
  FROM found GROUP BY person_id, event_id
),
refined AS MATERIALIZED (
  SELECT b.person_id, b.event_id,
         CASE moved WHEN 'care' THEN care WHEN 'pill' THEN pill ELSE b.episode_start_date END AS episode_start_date,
         b.start_category || ':REFINED' AS start_category, b.date_rank - 1 AS date_rank
  FROM (SELECT b.*, care, pill, coalesce(sign(care - b.episode_start_date), 9) AS care_side,
               coalesce(sign(pill - b.episode_start_date), 9) AS pill_side, coalesce(sign(care - pill), 9) AS apart
        FROM best b LEFT JOIN hints h ON h.person_id = b.person_id AND h.event_id = b.event_id) b
  LEFT JOIN (VALUES {_MOVES}) AS m(care_side, pill_side, apart, moved) USING (care_side, pill_side, apart)
  WHERE b.date_rank > 7
),
episodes AS MATERIALIZED (
  SELECT o.person_id, s.episode_start_date, o.event_date AS episode_end_date, s.start_category,
         o.category AS outcome_category, s.date_rank
  FROM accepted o JOIN (FROM all_starts UNION ALL FROM refined) s USING (person_id, event_id)
),
eligible AS MATERIALIZED (
  SELECT e.*, row_number() OVER (PARTITION BY e.person_id ORDER BY e.episode_start_date, e.episode_end_date) AS episode
  FROM (
    SELECT person_id, episode_end_date, arg_min(episode_start_date, date_rank) AS episode_start_date,
           arg_min(start_category, date_rank) AS start_category, any_value(outcome_category) AS outcome_category
    FROM episodes GROUP BY person_id, episode_end_date
  ) e
  JOIN person p USING (person_id)
  JOIN observation_period op ON op.person_id = e.person_id
    AND op.observation_period_start_date <= least(e.episode_start_date, e.episode_end_date)
    AND op.observation_period_end_date >= e.episode_end_date
  WHERE p.gender_concept_id <> 8507 AND year(e.episode_start_date) - p.year_of_birth BETWEEN 12 AND 55
),
corroborated AS MATERIALIZED (
  SELECT e.* FROM eligible e JOIN term_durations t ON t.category = e.outcome_category
  WHERE 2 <= (
    SELECT count(*) FROM moved m
    WHERE m.person_id = e.person_id AND m.event_date <= e.episode_end_date
      AND m.event_date > e.episode_end_date - t.max_term
  )
),
final AS MATERIALIZED (
  SELECT person_id, episode_start_date, episode_end_date, start_category AS start_method,
         outcome_category AS original_outcome, episode, n AS episode_length,
         CASE WHEN outcome_category IN ('LB', 'DELIV') THEN 'LB/DELIV'
              WHEN outcome_category IN ('SA', 'AB') OR (outcome_category = 'SB' AND n < 140) THEN 'SA/AB'
              ELSE outcome_category END AS outcome
  FROM (SELECT *, CAST(episode_end_date - episode_start_date + 1 AS INTEGER) AS n FROM corroborated)
)"""
    )


def _query(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select.strip()}"


def oracles() -> dict[str, str]:
    """SQL by query name."""
    written = _accept(forward=False, veto="cared_before")
    intended = _accept(forward=True, veto="cared_after")
    forward = _accept(forward=True, veto="cared_before")
    ahead = _accept(forward=False, veto="cared_after")
    births_written = _accept(forward=False, veto="cared_before", targets=("LB",))
    births_forward = _accept(forward=True, veto="cared_before", targets=("LB",))
    starts = written + _starts(own_prior=False)
    rows = "SELECT person_id, event_id, category, event_date FROM accepted"
    ranked = "SELECT person_id, event_id, episode_start_date, start_category, date_rank FROM"
    listed = "SELECT person_id, episode_start_date, episode_end_date, start_category, outcome_category, episode FROM"
    veto = "SELECT t.person_id, t.event_id, t.category, t.event_date FROM targets t JOIN {} v USING (person_id, event_id)"
    moves = "SELECT person_id, event_id, category, first_date AS event_date, event_date AS revised_date FROM targets"
    concepts = " ".join(f"WHEN '{c}' THEN {i}" for c, i in OUTCOME_CONCEPTS.items())
    sql = {
        "code_map_union": _query(
            RAW,
            "SELECT category, CAST(gest_value AS INTEGER) AS gest_value, person_id, start_date, type, value_as_string, "
            "CAST(value_as_number AS DOUBLE) AS value_as_number FROM raw_events",
        ),
        "glucose_only_exclusion": _query(RAW, "SELECT person_id, n_records FROM glucose_only"),
        "gestation_to_days": _query(
            EVENTS,
            "SELECT person_id, category, start_date AS event_date, CAST(gest_value AS DOUBLE) AS gest_value, count(*) AS n "
            "FROM nondrug GROUP BY ALL",
        ),
        "drug_hierarchy_expand": _query(
            EVENTS,
            "SELECT concept_id, category, ways, exposures "
            "FROM (SELECT concept_id, category, count(*) AS ways FROM drug_concepts GROUP BY ALL) "
            "JOIN (SELECT CAST(1000 + l_partkey % 40 AS INTEGER) AS concept_id, count(*) AS exposures "
            "FROM facts WHERE dom >= 8 GROUP BY ALL) "
            "USING (concept_id)",
        ),
        "coded_records_stored": _query(
            EVENTS,
            "SELECT person_id, CASE WHEN dom < 4 THEN 'Cond' WHEN dom < 6 THEN 'Proc' WHEN dom = 6 THEN 'Obs' ELSE 'Meas' END AS type, "
            "f.concept_id, category, d AS start_date FROM facts f JOIN pregnancy_concepts c ON c.concept_id = f.concept_id "
            "WHERE dom < 8 AND (dom < 6 OR c.data_value IN ('N/A', flag)) "
            "UNION ALL SELECT person_id, 'Drug', dc.concept_id, category, d FROM facts f "
            "JOIN drug_concepts dc ON dc.concept_id = 1000 + f.l_partkey % 40 WHERE dom >= 8",
        ),
        "drug_events": _query(
            EVENTS,
            "SELECT person_id, category, start_date AS event_date, count(*) AS n FROM drugs GROUP BY ALL",
        ),
        "numbered_events": _query(
            EVENTS,
            "SELECT person_id, event_id, category, event_date, CAST(gest_value AS DOUBLE) AS gest_value "
            "FROM pregnancy_events",
        ),
        "candidate_dedupe": _query(
            MOVED,
            "SELECT target, person_id, event_id, category, event_date, CAST(gest_value AS DOUBLE) AS gest_value "
            "FROM candidates",
        ),
        "first_candidate": _query(
            MOVED,
            "SELECT target, person_id, event_id, event_date FROM (SELECT *, row_number() OVER ("
            "PARTITION BY target, person_id ORDER BY event_date, event_id) AS rn "
            "FROM candidates WHERE category = target) WHERE rn = 1",
        ),
        "revise_ectopic": _query(MOVED, f"{moves} WHERE category = 'ECT'"),
        "revise_abortion": _query(MOVED, f"{moves} WHERE category IN ('AB', 'SA')"),
        "required_evidence": _query(
            MOVED,
            "SELECT t.person_id, t.event_id, t.first_date AS event_date FROM targets t "
            "JOIN proven USING (person_id, event_id)",
        ),
        "veto_lookback": _query(MOVED, veto.format("cared_before") + " WHERE t.category = 'SB'"),
        "veto_lookahead": _query(
            MOVED, veto.format("cared_after") + " WHERE t.category IN ('ECT', 'AB', 'SA', 'DELIV')"
        ),
        "spacing_conflicts": _query(
            births_forward,
            f"""
SELECT t.person_id, t.event_id, t.category, t.event_date,
       max(CASE WHEN a.event_date <= t.event_date THEN a.event_date END) AS birth_before,
       min(CASE WHEN a.event_date > t.event_date THEN a.event_date END) AS birth_after
FROM targets t JOIN accepted a ON a.person_id = t.person_id
WHERE t.category <> 'LB'
GROUP BY ALL
HAVING bool_or(abs((t.event_date - a.event_date) + 1) <
  CASE WHEN a.event_date <= t.event_date THEN {_LIMITS}['LB>' || t.category] ELSE {_LIMITS}[t.category || '>LB'] END)""",
        ),
        "spacing_conflicts_all": _query(
            forward,
            f"""
SELECT DISTINCT t.person_id, t.event_id, t.category, t.event_date
FROM targets t JOIN accepted a ON a.person_id = t.person_id AND a.event_id <> t.event_id
WHERE abs((t.event_date - a.event_date) + 1) < CASE WHEN a.event_date <= t.event_date
  THEN {_LIMITS}[a.category || '>' || t.category] ELSE {_LIMITS}[t.category || '>' || a.category] END""",
        ),
        "accept_lb_as_written": _query(births_written, rows),
        "accept_lb_forward": _query(births_forward, rows),
        "accept_all_as_written": _query(written, rows),
        "accept_all_forward": _query(forward, rows),
        "accept_all_veto_ahead": _query(ahead, rows),
        "accept_all_intended": _query(intended, rows),
        "prior_outcome": _query(
            written + OUTCOME_ROWS,
            "SELECT person_id, event_id, category, event_date, prior_date AS prior_outcome_date, prior_category "
            "FROM accepted JOIN prior USING (person_id, event_id)",
        ),
        "start_default": _query(
            starts, "SELECT person_id, event_id, episode_start_date, start_category FROM assumed"
        ),
        "all_starts": _query(starts, f"{ranked} all_starts"),
        "best_start": _query(starts, f"{ranked} best"),
        "refined_start": _query(starts, f"{ranked} refined"),
        "episode_all_candidates": _query(
            starts,
            "SELECT person_id, episode_start_date, episode_end_date, start_category, outcome_category, date_rank "
            "FROM episodes",
        ),
        "episodes_eligible": _query(starts, f"{listed} eligible"),
        "episodes_corroborated": _query(starts, f"{listed} corroborated"),
        "episodes_final": _query(starts, "SELECT * FROM final"),
        "episodes_final_split": _query(starts, "SELECT * FROM final"),
        "episodes_final_early": _query(starts, "SELECT * FROM final"),
        "episodes_final_events": _query(starts, "SELECT * FROM final"),
        "episodes_final_intended": _query(intended + _starts(own_prior=True), "SELECT * FROM final"),
        "full_outer_prior_terms": _query(
            written + OUTCOME_ROWS,
            "SELECT p.person_id, p.event_id, p.prior_category, t.category AS term_category, t.max_term, t.min_term, t.retry "
            "FROM prior p FULL JOIN term_durations t ON t.category = p.prior_category",
        ),
        "mother_table": _query(
            starts,
            f"""
SELECT person_id, row_number() OVER (ORDER BY person_id, episode) AS pregnancy_id,
       episode_start_date AS pregnancy_start_date, episode_end_date AS pregnancy_end_date,
       episode_length AS gestational_length_in_day,
       CAST(CASE original_outcome {concepts} ELSE 0 END AS DOUBLE) AS original_outcome,
       CAST(NULL AS INTEGER) AS pregnancy_mode_delivery, CAST(NULL AS INTEGER) AS pregnancy_single,
       episode - 1 AS prev_pregnancy_gravidity
FROM final""",
        ),
        "length_histogram": _query(
            starts,
            "SELECT CAST(floor(episode_length / 10) AS INTEGER) AS week, count(*) AS n FROM final "
            "WHERE original_outcome IN ('LB', 'DELIV') AND year(episode_start_date) BETWEEN 1987 AND 2013 "
            "AND episode_length < 310 AND episode_length <> 0 GROUP BY ALL",
        ),
        "episodes_per_person": _query(
            starts,
            "SELECT n_pregnancies, count(*) AS n FROM "
            "(SELECT person_id, count(*) AS n_pregnancies FROM final GROUP BY person_id) GROUP BY ALL",
        ),
        "outcome_counts": _query(
            starts, "SELECT original_outcome, count(*) AS n FROM final GROUP BY original_outcome"
        ),
        "outcome_concept_counts": _query(
            starts,
            f"SELECT CAST(CASE original_outcome {concepts} ELSE 0 END AS DOUBLE) AS original_outcome, count(*) AS n "
            "FROM final GROUP BY ALL",
        ),
    }
    rule_queries = {
        "lmp": "LMP",
        "gest": "GEST",
        "ovul": "OVUL",
        "ovul2": "OVUL2",
        "nuchal": "NULS",
        "afp": "AFP",
        "amen": "AMEN",
        "up": "UP",
        "pushback": "PUSHBACK",
        "contra": "CONTRA",
    }
    rule_row = "SELECT person_id, event_id, episode_start_date, rule AS start_category FROM found WHERE rule = '{}'"
    sql["drug_hierarchy_stored"] = sql["drug_hierarchy_expand"]
    for short, name in rule_queries.items():
        sql[f"start_{short}"] = _query(starts, rule_row.format(name))
    sql["start_ovul2_person"] = _query(
        written + _starts(own_prior=True), rule_row.format("OVUL2")
    )
    return sql
