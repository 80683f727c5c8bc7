"""The same queries as SQL for a second engine, to compare results with."""

from __future__ import annotations

from triagelake.functions.columns import WORD
from triagelake.functions.fixed import CRITERIA, INSTRUCTIONS
from triagelake.functions.fixed import PRICE_PER_MILLION_TOKENS as PRICE
from triagelake.plans import model as m
from triagelake.plans import queries as q


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _issues() -> str:
    return """
issue_rows AS (
  SELECT d.*, o.*, l.quality, l.toxic
  FROM documents d JOIN orders o ON d.doc_id = o.o_orderkey LEFT JOIN labels l ON l.doc_id = d.doc_id
),
issues AS (
  SELECT doc_id AS id, source AS repo, doc_id + 1 AS number, split_part(text, chr(10), 1) AS title,
         text AS body,
         CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'pending' END AS state,
         CAST(o_orderdate AS varchar) AS created_at, CAST(o_orderdate AS varchar) AS updated_at,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS varchar) END AS closed_at,
         list_filter([lang, CASE WHEN quality = 1 THEN 'quality' END,
                      CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS labels
  FROM issue_rows
)"""


def _scored(name: str, rows: str, version: str = m.VERSION) -> str:
    """CTEs adding choice, confidence and input_tokens to ``rows`` (with a column ``body``)."""
    terms = m.TERMS[version]
    counts = ", ".join(
        f"len(list_filter(words, lambda x: x IN ({_list(words)}))) AS n_{lang}"
        for lang, words in terms.items()
    )
    names = [f"n_{lang}" for lang in terms]
    top, total = f"greatest({', '.join(names)})", " + ".join(names)
    choice = " ".join(f"WHEN n_{lang} = {top} THEN '{lang}'" for lang in terms)
    return f"""
{name}_words AS (SELECT *, string_split_regex(lower(body), '[^{WORD}]+') AS words FROM {rows}),
{name}_hits AS (SELECT *, {counts} FROM {name}_words),
{name} AS (
  SELECT *, CASE WHEN {top} = 0 THEN 'other' {choice} END AS choice,
         CASE WHEN {total} > 0 THEN {top} / ({total}) ELSE 0.0e0 END AS confidence,
         CAST(floor(length(body) / 4) + 1 AS integer) AS input_tokens
  FROM {name}_hits
)"""


COST = f"input_tokens / 1000000.0e0 * {PRICE}e0"

ISSUES = "WITH " + _issues()
CLASSIFICATIONS = (
    ISSUES
    + """,
class_rows AS (
  SELECT doc_id AS issue_id, text AS body,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'before'
              ELSE CAST(o_orderdate AS varchar) END AS issue_updated_at,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'v1' ELSE 'v2' END AS classifier_version
  FROM issue_rows WHERE o_orderpriority <> '5-LOW'
),"""
    + _scored("scored", "class_rows")
    + f""",
classifications AS (
  SELECT issue_id, choice AS issue_type, confidence, issue_updated_at, input_tokens,
         '{m.MODEL}' AS model, classifier_version, {COST} AS estimated_cost_usd
  FROM scored
)"""
)
DOCS = "documents_body AS (SELECT doc_id AS issue_id, text AS body FROM documents),"
SCORED = "WITH " + DOCS + _scored("scored", "documents_body")
PREDICTIONS = (
    SCORED
    + """,
predictions AS (SELECT issue_id, choice AS predicted_type, confidence, input_tokens FROM scored),
eval_set AS (
  SELECT source AS repo, doc_id AS issue_id, split_part(text, chr(10), 1) AS title, text AS body,
         lang AS human_type
  FROM documents
)"""
)
PAIRS = (
    PREDICTIONS
    + """,
pairs AS (
  SELECT e.human_type AS actual, p.predicted_type AS predicted, count(*) AS n
  FROM eval_set e JOIN predictions p USING (issue_id) GROUP BY ALL
)"""
)
LINES = f"""WITH order_issues AS (
  SELECT o_orderkey AS id, o_orderpriority AS repo, o_custkey AS number,
         'Order of customer ' || CAST(o_custkey AS varchar) AS title, o_orderstatus AS body,
         CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE 'pending' END AS state,
         CAST(o_orderdate AS varchar) AS created_at, CAST(o_orderdate AS varchar) AS updated_at
  FROM orders
),
line_rows AS (
  SELECT l_orderkey AS issue_id, l_returnflag AS issue_type, l_quantity / 45.0e0 AS confidence,
         CAST(l_shipdate AS varchar) AS issue_updated_at,
         CAST(floor(l_extendedprice) AS integer) AS input_tokens, '{m.MODEL}' AS model,
         l_linestatus AS classifier_version
  FROM lineitem
),
lines AS (SELECT *, {COST} AS estimated_cost_usd FROM line_rows)"""


def _metrics(pairs: str, by: str = "") -> str:
    """CTE class_metrics from ``pairs``; ``by`` is '' or 'classifier_version, '."""
    using = "USING (classifier_version, class)" if by else "USING (class)"
    names = f"SELECT unnest([{_list(m.LANGUAGES)}]) AS class"
    grid = f"SELECT DISTINCT {by}class FROM {pairs}, ({names})" if by else names
    return f"""
known AS (SELECT * FROM {pairs} WHERE actual IN ({_list(m.LANGUAGES)})),
by_row AS (
  SELECT {by}actual AS class, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp, sum(n) AS row_n
  FROM known GROUP BY ALL
),
by_column AS (SELECT {by}predicted AS class, sum(n) AS col_n FROM known GROUP BY ALL),
counted AS (
  SELECT {by}class, CAST(coalesce(tp, 0) AS bigint) AS tp,
         CAST(coalesce(col_n, 0) - coalesce(tp, 0) AS bigint) AS fp,
         CAST(coalesce(row_n, 0) - coalesce(tp, 0) AS bigint) AS fn
  FROM ({grid}) LEFT JOIN by_row {using} LEFT JOIN by_column {using}
),
rated AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0e0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0e0 END AS recall
  FROM counted
),
class_metrics AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0e0 END AS f1
  FROM rated
)"""


def _macro() -> str:
    each = " + ".join(
        f"coalesce(max(CASE WHEN class = '{c}' THEN f1 END), 0.0e0)" for c in m.LANGUAGES
    )
    return f"({each}) / {len(m.LANGUAGES)} AS macro_f1"


def _quality(issues: str, cls: str, version: str, classes: list[str]) -> str:
    v = version.upper()
    required = "[CAST(id AS varchar), repo, CAST(number AS varchar), title, state, created_at, updated_at]"
    return f"""
of_issues AS (
  SELECT count(*) FILTER (len(list_filter({required}, lambda x: x IS NULL)) > 0) AS missing,
         count(*) FILTER (coalesce(state, '?') NOT IN ('open', 'closed')) AS states
  FROM {issues}
),
of_current AS (
  SELECT count(*) FILTER (coalesce(issue_type, '?') NOT IN ({_list(classes)})) AS classes,
         count(*) FILTER (NOT coalesce(confidence BETWEEN 0 AND 1, false)) AS confidences
  FROM {cls} WHERE classifier_version = '{version}'
),
issue_copies AS (SELECT row_number() OVER (PARTITION BY id) AS copy FROM {issues}),
class_copies AS (SELECT row_number() OVER (PARTITION BY issue_id) AS copy FROM {cls}),
counted AS (
  SELECT (SELECT count(*) FROM issue_copies WHERE copy = 2) AS "Duplicate issue IDs",
         missing AS "Missing required issue fields", states AS "Invalid issue states",
         (SELECT count(*) FROM {cls} c WHERE NOT EXISTS (FROM {issues} i WHERE i.id = c.issue_id))
           AS "Classification IDs missing from issues",
         (SELECT count(*) FROM class_copies WHERE copy = 2) AS "Duplicate classification issue IDs",
         classes AS "Invalid {v} classes", confidences AS "Invalid {v} confidence values",
         (SELECT count(*) FILTER (issue_updated_at IS DISTINCT FROM updated_at)
          FROM {issues} JOIN {cls} ON id = issue_id AND classifier_version = '{version}')
           AS "Stale {v} classifications"
  FROM of_issues, of_current
)
SELECT "check", violations, if(violations = 0, 'PASS', 'FAIL') AS status
FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME "check" VALUE violations)"""


def _coverage(issues: str, cls: str, version: str) -> str:
    return f"""
SELECT classified, total, CASE WHEN total > 0 THEN classified / total ELSE 0.0e0 END * 100 AS coverage
FROM (SELECT count(*) AS total FROM {issues}),
     (SELECT count(*) AS classified FROM {cls} WHERE classifier_version = '{version}')"""


def _pending(issues: str, cls: str, version: str) -> str:
    return f"""
SELECT id, title, body, updated_at FROM {issues}
WHERE NOT EXISTS (FROM {cls} WHERE issue_id = id)
UNION ALL
SELECT id, title, body, updated_at FROM {cls} JOIN {issues} ON id = issue_id
WHERE NOT (issue_updated_at IS NOT DISTINCT FROM updated_at
           AND classifier_version IS NOT DISTINCT FROM '{version}')"""


def _admitted(rows: str, spent: str, cap: float, reserve: float) -> str:
    return f"""
running AS (
  SELECT id, input_tokens, coalesce(sum(input_tokens) OVER (
    ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM {rows}
)
SELECT id, input_tokens FROM running
WHERE ({spent}) + before * {PRICE}e0 / 1000000.0e0 < {cap}e0 - {reserve}e0"""


def _capped(total_cap: int) -> str:
    caps = ", ".join(f"('{r}', {i}, {c})" for i, (r, c) in enumerate(q.ORDER_CAPS.items()))
    return (
        LINES
        + f""",
stored AS (SELECT * FROM order_issues WHERE state = 'pending'),
fresh AS (SELECT * FROM order_issues WHERE id NOT IN (SELECT id FROM stored)),
caps(repo, place, cap) AS (VALUES {caps}),
room AS (
  SELECT repo, place, coalesce(have, 0) AS have,
         greatest(0, least(cap - coalesce(have, 0), coalesce(available, 0))) AS want
  FROM caps LEFT JOIN (SELECT repo, count(*) AS have FROM stored GROUP BY repo) USING (repo)
            LEFT JOIN (SELECT repo, count(*) AS available FROM fresh GROUP BY repo) USING (repo)
),
takes AS (
  SELECT repo, greatest(0, least(want, {total_cap} - sum(have) OVER () - coalesce(sum(want) OVER (
    ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take
  FROM room
),
ranked AS (
  SELECT repo, id, created_at, row_number() OVER (PARTITION BY repo ORDER BY created_at DESC, id) AS rn
  FROM fresh
)
SELECT repo, id, created_at FROM ranked JOIN takes USING (repo) WHERE rn <= take"""
    )


def _balanced(rows: str, class_col: str, group_col: str, key: str, n: int) -> str:
    return f"""
turns AS (
  SELECT *, md5('42:' || CAST({key} AS varchar)) AS h, row_number() OVER (
    PARTITION BY {class_col}, {group_col} ORDER BY h, {key}) AS turn
  FROM {rows}
),
places AS (
  SELECT *, row_number() OVER (PARTITION BY {class_col} ORDER BY turn, {group_col}, {key}) AS place
  FROM turns
)
SELECT {class_col}, {group_col}, {key} FROM places WHERE place <= {n}"""


def _split(rows: str, class_col: str, key: str) -> str:
    return f"""
ranked AS (
  SELECT *, md5('42:' || CAST({key} AS varchar)) AS h,
         row_number() OVER (PARTITION BY {class_col} ORDER BY h, {key}) AS rn,
         count(*) OVER (PARTITION BY {class_col}) AS n
  FROM {rows}
)
SELECT {key}, {class_col},
       CASE WHEN rn <= greatest(1, round_even(n * 0.25e0, 0)) THEN 'test' ELSE 'dev' END AS part
FROM ranked"""


def _label_map() -> str:
    return ", ".join(
        f"('{repo}', '{label}', '{cls}')"
        for repo, classes in m.LABEL_MAP.items()
        for label, cls in classes.items()
    )


EXACT = f"CASE WHEN len(labels) = 1 AND labels[1] IN ({_list(m.LANGUAGES)}) THEN labels[1] END"
AGREED = (
    CLASSIFICATIONS
    + f""",
human AS (SELECT *, {EXACT} AS human_type FROM issues),
agreed AS (
  SELECT h.*, c.issue_type, c.confidence FROM human h JOIN classifications c ON h.id = c.issue_id
  WHERE human_type IS NOT NULL
)"""
)
ERRORS = (
    PREDICTIONS
    + """
SELECT human_type, predicted_type, confidence, repo, title
FROM eval_set JOIN predictions USING (issue_id) WHERE human_type <> predicted_type"""
)
PIECES = "SELECT repo, label, count(*) AS n FROM (SELECT repo, unnest(labels) AS label FROM issues)"
RECORDS = (
    ISSUES
    + """
SELECT repo, id, number, title, body, state, created_at, updated_at, closed_at,
       array_to_string(labels, '|') AS labels
FROM issues"""
)
SPENT = f"""SELECT coalesce(sum(estimated_cost_usd), 0.0e0)
  FROM lines WHERE classifier_version = '{q.LINE_VERSION}' AND confidence > 1"""
ORGANISED = RECORDS.replace("SELECT repo, id", "SELECT 'org/' || repo AS repo, id")
CURRENT_LINES = f"FROM lines WHERE classifier_version = '{q.LINE_VERSION}'"

ORACLE: dict[str, str] = {
    "pending": CLASSIFICATIONS + _pending("issues", "classifications", m.VERSION),
    "pending_first": CLASSIFICATIONS
    + _pending("issues", "classifications", m.VERSION)
    + " ORDER BY id LIMIT 20",
    "pending_orders": LINES + _pending("order_issues", "lines", q.LINE_VERSION),
    "ingest_pages": ORGANISED,
    "ingest_stream": ORGANISED,
    "landing_states": ISSUES
    + """,
landed AS (SELECT DISTINCT 'org/' || repo AS repo, id // 100 AS page FROM issues)
SELECT repo, count(*) AS pages, count(*) FILTER (page = length(repo)) AS last_pages,
       count(*) FILTER (page = length(repo)) > 0 AS finished
FROM landed GROUP BY repo""",
    "normalise_issues": RECORDS,
    "existing_counts": LINES + " SELECT repo, count(DISTINCT id) AS n FROM order_issues GROUP BY repo",
    "new_records": LINES + " SELECT * FROM order_issues WHERE state <> 'pending'",
    "capped_ingest": _capped(q.TOTAL_CAP),
    "capped_ingest_total": _capped(q.LOW_TOTAL_CAP),
    "score_stream": ISSUES
    + ", sent AS (SELECT id, updated_at, body FROM issues),"
    + _scored("scored", "sent")
    + f"""
SELECT id AS issue_id, choice AS issue_type, confidence, updated_at AS issue_updated_at, input_tokens,
       '{m.MODEL}' AS model, 'v2' AS classifier_version, {COST} AS estimated_cost_usd
FROM scored""",
    "csv_roundtrip": PREDICTIONS
    + """
SELECT issue_id, repo, issue_id + 1 AS number, title, body, human_type AS github_labels,
       human_type AS weak_label, predicted_type, confidence, CAST(NULL AS varchar) AS gold_label
FROM eval_set JOIN predictions USING (issue_id)""",
    "schema_evolve": LINES
    + """
SELECT issue_id, issue_type, confidence, CAST(NULL AS varchar) AS issue_updated_at,
       CAST(NULL AS integer) AS input_tokens, CAST(NULL AS varchar) AS model,
       CAST(NULL AS varchar) AS classifier_version, CAST(NULL AS double) AS estimated_cost_usd
FROM lines""",
    "raw_arrays": ORGANISED,
    "repo_parts": """
SELECT doc_id, 'org' AS owner, source AS name FROM documents""",
    "replace_table": LINES + " SELECT * FROM order_issues",
    "stored_evolution": LINES
    + f"""
SELECT issue_id, issue_type, confidence, NULL AS issue_updated_at, NULL AS input_tokens, NULL AS model,
       NULL AS classifier_version, NULL AS estimated_cost_usd, NULL AS classified_at
FROM lines WHERE classifier_version <> '{q.LINE_VERSION}'
UNION ALL
SELECT issue_id, issue_type, confidence, issue_updated_at, input_tokens, model, classifier_version,
       estimated_cost_usd, '{m.CLASSIFIED_AT}'
{CURRENT_LINES}""",
    "stored_times": LINES
    + f"""
SELECT issue_type, count(*) AS n, count(*) AS n_recent, 'timestamp' AS kind, true AS one_time
{CURRENT_LINES}
GROUP BY issue_type""",
    "usage_ledger": CLASSIFICATIONS
    + """
SELECT issue_id, classifier_version, model, input_tokens, estimated_cost_usd FROM classifications""",
    "upsert_latest": CLASSIFICATIONS
    + ", open_issues AS (SELECT * FROM issues WHERE state = 'open'),"
    + _scored("fresh", "open_issues", "v3")
    + """
SELECT issue_id, issue_type, confidence, issue_updated_at, classifier_version FROM classifications
WHERE issue_id NOT IN (SELECT id FROM open_issues)
UNION ALL SELECT id, choice, confidence, updated_at, 'v3' FROM fresh""",
    "resume_pending": CLASSIFICATIONS
    + f"""
SELECT doc_id AS issue_id, source AS repo, split_part(text, chr(10), 1) AS title, lang AS human_type
FROM documents WHERE doc_id NOT IN (
  SELECT issue_id FROM classifications WHERE classifier_version = '{m.VERSION}')""",
    "resume_scores": CLASSIFICATIONS
    + f""",
left_over AS (
  SELECT doc_id AS issue_id, text AS body FROM documents
  WHERE doc_id NOT IN (SELECT issue_id FROM classifications WHERE classifier_version = '{m.VERSION}')
),"""
    + _scored("resumed", "left_over")
    + f"""
SELECT issue_id, choice AS predicted_type, confidence, input_tokens,
       '{m.VERSION}' AS classifier_version
FROM resumed""",
    "edited_records": LINES
    + """
SELECT repo, id, max(issue_updated_at) AS updated_at
FROM lines JOIN order_issues ON id = issue_id AND issue_updated_at > updated_at GROUP BY repo, id""",
    "budget_admit": "WITH "
    + DOCS
    + """
costs AS (
  SELECT issue_id AS id, CAST(floor(length(body) / 4) + 1 AS integer) AS input_tokens
  FROM documents_body
),"""
    + _admitted("costs", "0", **q.BUDGET),
    "budget_admit_orders": LINES
    + """,
costs AS (SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS bigint) AS input_tokens FROM orders),"""
    + _admitted("costs", SPENT, **q.ORDER_BUDGET),
    "admitted_pending": CLASSIFICATIONS
    + ", waiting AS ("
    + _pending("issues", "classifications", m.VERSION)
    + """),
costs AS (
  SELECT id, CAST(floor(length(body) / 4) + 1 AS integer) AS input_tokens FROM waiting
),
admitted AS ("""
    + _admitted(
        "costs",
        f"""SELECT coalesce(sum(estimated_cost_usd), 0.0e0)
  FROM classifications WHERE classifier_version = '{m.VERSION}' AND issue_type = 'other'""",
        **q.PENDING_BUDGET,
    ).replace("running AS (", "WITH running AS (", 1)
    + ") SELECT * FROM waiting WHERE id IN (SELECT id FROM admitted)",
    "keyword_score": SCORED + " SELECT issue_id, choice, confidence, input_tokens FROM scored",
    "scoring_response": SCORED + " SELECT issue_id, choice, confidence, input_tokens FROM scored",
    "batch_score": "WITH documents_body AS (SELECT doc_id AS issue_id, text AS body FROM documents),"
    + _scored("scored", "documents_body")
    + " SELECT issue_id, choice, confidence, input_tokens FROM scored",
    "scoring_request": ISSUES
    + f"""
SELECT id, '{m.MODEL}' AS model, title, substr(body, 1, 4000) AS body, '{INSTRUCTIONS}' AS question,
       '{CRITERIA[m.VERSION]["other"]}' AS other
FROM issues""",
    "run_summary": CLASSIFICATIONS
    + f"""
SELECT processed, input_tokens, input_tokens / processed AS average_tokens, {COST} AS cost_usd,
       (input_tokens / processed * 100000) / 1000000.0e0 * {PRICE}e0 AS projected_cost_usd
FROM (SELECT count(*) AS processed, CAST(sum(input_tokens) AS bigint) AS input_tokens
      FROM classifications)""",
    "cost_projection": PREDICTIONS
    + f"""
SELECT average_tokens, average_tokens * 100000 / 1000000.0e0 * {PRICE}e0 AS projected_cost_usd
FROM (SELECT avg(input_tokens) AS average_tokens FROM predictions)""",
    "exact_label_class": ISSUES + f" SELECT id, {EXACT} AS human_type FROM issues",
    "map_labels": ISSUES
    + f""",
label_map(repo, label, class) AS (VALUES {_label_map()}),
mapped AS (
  SELECT id, min(class) AS human_type
  FROM (SELECT id, repo, unnest(labels) AS label FROM issues) JOIN label_map USING (repo, label)
  GROUP BY id HAVING count(DISTINCT class) = 1
)
SELECT repo, id AS issue_id, title, human_type FROM issues JOIN mapped USING (id)""",
    "label_counts": ISSUES + f" {PIECES} GROUP BY ALL",
    "label_search": ISSUES
    + f" {PIECES} WHERE "
    + " OR ".join(f"lower(label) LIKE '%{t}%'" for t in q.SEARCH_TERMS)
    + " GROUP BY ALL",
    "top_labels": ISSUES
    + f""",
counted AS ({PIECES} GROUP BY ALL)
SELECT repo, label, n,
       CAST(row_number() OVER (PARTITION BY repo ORDER BY n DESC, label) AS integer) AS rank
FROM counted QUALIFY rank <= {q.TOP}""",
    "balanced_sample": PREDICTIONS
    + ","
    + _balanced("eval_set", "human_type", "repo", "issue_id", q.SAMPLE),
    "sample_profile": "SELECT human_type, repo, count(*) AS n FROM ("
    + PREDICTIONS
    + ","
    + _balanced("eval_set", "human_type", "repo", "issue_id", q.SAMPLE)
    + ") AS drawn GROUP BY human_type, repo",
    "balanced_sample_orders": "WITH "
    + _balanced("orders", "o_orderstatus", "o_custkey", "o_orderkey", 2_000),
    "gold_review": PREDICTIONS
    + ","
    + _issues()
    + f""",
numbered AS (
  SELECT id AS issue_id, number, array_to_string(labels, '|') AS github_labels FROM issues
)
SELECT issue_id, repo, number, title, body, github_labels, human_type AS weak_label, predicted_type,
       confidence, '' AS gold_label
FROM predictions JOIN numbered USING (issue_id) JOIN eval_set USING (issue_id)
QUALIFY row_number() OVER (
  PARTITION BY human_type ORDER BY md5(CAST(issue_id AS varchar)), issue_id) <= {q.REVIEW}""",
    "stratified_split": "WITH gold AS (SELECT doc_id AS issue_id, lang AS gold_label FROM documents),"
    + _split("gold", "gold_label", "issue_id"),
    "stratified_split_orders": "WITH" + _split("orders", "o_orderstatus", "o_orderkey"),
    "quality_suite": CLASSIFICATIONS
    + ","
    + _quality("issues", "classifications", m.VERSION, ["en", "fr", "other"]),
    "quality_suite_lines": LINES
    + ", known_issues AS (SELECT * FROM order_issues WHERE state <> 'pending'),"
    + _quality("known_issues", "lines", q.LINE_VERSION, q.LINE_CLASSES),
    "gate": f"""
SELECT "check", violations FROM ({
    CLASSIFICATIONS + "," + _quality("issues", "classifications", m.VERSION, ["en", "fr", "other"])
}) WHERE status = 'FAIL'""",
    "triage": ISSUES
    + f""",
sound AS (
  SELECT *, {EXACT} AS human_type FROM issues
  WHERE state IN ('open', 'closed') AND id IS NOT NULL AND repo IS NOT NULL AND title IS NOT NULL
),"""
    + _scored("scored", "sound")
    + """
SELECT 'classes' AS part, choice AS name, count(*) AS n FROM scored GROUP BY ALL
UNION ALL SELECT 'repos', 'org/' || repo, count(*) FROM scored GROUP BY ALL
UNION ALL SELECT 'states', state, count(*) FROM scored GROUP BY ALL
UNION ALL SELECT 'agreement', 'correct', count(*) FROM scored WHERE human_type = choice
UNION ALL SELECT 'agreement', 'total', count(*) FROM scored WHERE human_type IS NOT NULL
UNION ALL SELECT 'processed', 'run-1', count(*) FROM scored""",
    "duplicate_keys": """
SELECT count(*) AS violations FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
    "orphans": LINES
    + """
SELECT issue_id, issue_type, input_tokens, classifier_version FROM lines
WHERE issue_id NOT IN (SELECT id FROM order_issues WHERE state <> 'pending')""",
    "stale": CLASSIFICATIONS
    + f"""
SELECT issue_id, issue_updated_at, updated_at
FROM issues JOIN classifications ON id = issue_id AND issue_updated_at IS DISTINCT FROM updated_at
WHERE classifier_version = '{m.VERSION}'""",
    "agreement": AGREED
    + """
SELECT count(*) FILTER (human_type = issue_type) AS correct, count(*) AS total,
       count(*) FILTER (human_type = issue_type) / nullif(count(*), 0) AS agreement
FROM agreed""",
    "agreement_counts": AGREED
    + " SELECT human_type, issue_type AS predicted_type, count(*) AS n FROM agreed GROUP BY ALL",
    "agreement_mismatches": AGREED
    + """
SELECT number, title, human_type, issue_type, confidence FROM agreed WHERE human_type <> issue_type""",
    "mismatches": ERRORS + " ORDER BY confidence DESC, issue_id LIMIT 5",
    "mismatch_list": ERRORS,
    "confusion": PAIRS
    + f"""
SELECT actual, predicted, coalesce(n, 0) AS n
FROM (SELECT unnest([{_list(m.LANGUAGES)}]) AS actual)
CROSS JOIN (SELECT unnest([{_list(q.KNOWN)}]) AS predicted)
LEFT JOIN pairs USING (actual, predicted)""",
    "confusion_wide": PAIRS
    + "\nSELECT actual, "
    + ", ".join(
        f"CAST(sum(CASE WHEN predicted = '{c}' THEN n ELSE 0 END) AS bigint) AS \"{c}\""
        for c in q.KNOWN
    )
    + " FROM pairs GROUP BY actual",
    "accuracy": PAIRS
    + f"""
SELECT CAST(sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS bigint) AS correct,
       CAST(sum(n) AS bigint) AS total,
       CAST(sum(CASE WHEN predicted NOT IN ({_list(m.LANGUAGES)}) THEN n ELSE 0 END) AS bigint) AS unexpected,
       sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) AS accuracy
FROM pairs""",
    "class_metrics": PAIRS + "," + _metrics("pairs") + " SELECT * FROM class_metrics",
    "macro_f1": PAIRS + "," + _metrics("pairs") + f" SELECT {_macro()} FROM class_metrics",
    "token_stats": PREDICTIONS
    + """
SELECT CAST(sum(input_tokens) AS bigint) AS total_tokens, avg(input_tokens) AS average_tokens
FROM predictions""",
    "compare_versions": "WITH "
    + DOCS
    + _scored("first", "documents_body", "v2")
    + ","
    + _scored("second", "documents_body", "v3")
    + f""",
both_versions AS (
  SELECT 'v2' AS classifier_version, issue_id, choice FROM first
  UNION ALL SELECT 'v3', issue_id, choice FROM second
),
pairs AS (
  SELECT classifier_version, d.lang AS actual, choice AS predicted, count(*) AS n
  FROM both_versions JOIN documents d ON d.doc_id = issue_id GROUP BY ALL
),{_metrics("pairs", "classifier_version, ")},
rates AS (
  SELECT classifier_version, CAST(sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS bigint) AS correct,
         CAST(sum(n) AS bigint) AS total,
         sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) AS accuracy
  FROM pairs GROUP BY ALL
),
macros AS (SELECT classifier_version, {_macro()} FROM class_metrics GROUP BY ALL)
SELECT r.*, macro_f1, CASE WHEN classifier_version <> 'v2' THEN
         accuracy > (SELECT accuracy FROM rates WHERE classifier_version = 'v2')
         AND macro_f1 > (SELECT macro_f1 FROM macros WHERE classifier_version = 'v2') END AS accepted
FROM rates r JOIN macros USING (classifier_version)""",
    "coverage": CLASSIFICATIONS + _coverage("issues", "classifications", m.VERSION),
    "coverage_lines": LINES + _coverage("order_issues", "lines", q.LINE_VERSION),
    "coverage_distinct": LINES
    + _coverage("order_issues", "lines", q.LINE_VERSION).replace(
        "SELECT count(*) AS classified", "SELECT count(DISTINCT issue_id) AS classified"
    ),
    "usage_totals": LINES
    + f"""
SELECT CAST(sum(input_tokens) AS bigint) AS total_tokens,
       round(sum(estimated_cost_usd), 6) AS total_cost_usd
{CURRENT_LINES}""",
    "repo_counts": LINES + " SELECT repo, count(*) AS n FROM order_issues GROUP BY repo",
    "state_counts": LINES + " SELECT state, count(*) AS n FROM order_issues GROUP BY state",
    "class_counts": LINES + f" SELECT issue_type, count(*) AS n {CURRENT_LINES} GROUP BY issue_type",
    "avg_confidence": LINES
    + f"""
SELECT issue_type, round(avg(confidence), 3) AS avg_confidence
{CURRENT_LINES} GROUP BY issue_type""",
    "low_confidence": LINES + f" SELECT count(*) AS n {CURRENT_LINES} AND confidence < {q.LOW}",
    "lowest_examples": LINES
    + f"""
SELECT number, title, issue_type, confidence FROM order_issues JOIN lines ON id = issue_id
WHERE classifier_version = '{q.LINE_VERSION}' AND confidence < {q.LOW}
QUALIFY row_number() OVER (ORDER BY confidence, issue_id, issue_type, number) <= {q.EXAMPLES}""",
}
