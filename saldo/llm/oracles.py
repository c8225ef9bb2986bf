"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from saldo.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS

ORACLES: dict[str, str] = {}

ORACLES["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{v}' THEN {w}::DOUBLE" for v, w in MIX_WEIGHTS.get(level, {}).items())
    return f"CASE {cases} ELSE 1.0::DOUBLE END" if cases else "1.0::DOUBLE"


def _level(name: str, path: list[str], above: str) -> str:
    """CTEs that share the budgets in `above` among the nodes of `path`."""
    parent, cols = path[:-1], ", ".join(path)
    on = f"JOIN {above} USING ({', '.join(parent)})" if parent else f"CROSS JOIN {above}"
    part = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"{part} ORDER BY room / w, {path[-1]}"
    return f"""
{name}_nodes AS (SELECT {cols}, sum(room)::DOUBLE AS room, {_weight(path[-1])} AS w FROM leaves GROUP BY {cols}),
{name}_rated AS (
  SELECT n.*, budget,
    (budget - coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM {name}_nodes n {on}),
{name}_open AS (SELECT *, max(CASE WHEN room / w > rate THEN rate END) OVER ({part}) AS top FROM {name}_rated),
{name} AS (SELECT {cols}, CASE WHEN top IS NULL THEN room ELSE least(room, w * top) END AS budget FROM {name}_open)"""


ORACLES["op7_mixing"] = f"""
WITH d AS (
  SELECT doc_id, ceil(strlen(text) / 4.0)::BIGINT AS tokens,
    'domain' || (coalesce(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS BIGINT), 0) % 4) AS domain,
    coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, hash(text) AS text_hash
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, sum(tokens)::BIGINT * {MIX_EPOCHS} AS room FROM d GROUP BY ALL),
root AS (SELECT floor(sum(supply) * {MIX_SHARE}::DOUBLE)::DOUBLE AS budget FROM leaves),
{_level("a", ["domain"], "root")},
{_level("b", ["domain", "lang"], "a")},
{_level("c", ["domain", "lang", "source"], "b")},
budgets AS (SELECT l.domain, l.lang, l.source, supply, floor(budget + 1e-6)::BIGINT AS leaf_budget FROM leaves l JOIN c USING (domain, lang, source)),
parts AS (SELECT *, CASE WHEN supply > 0 THEN leaf_budget // supply ELSE 0 END AS whole FROM budgets),
ordered AS (
  SELECT d.*, leaf_budget, whole, leaf_budget - whole * supply AS rest,
    sum(tokens) OVER (PARTITION BY domain, lang, source
      ORDER BY md5('{MIX_SEED}:' || whole || ':' || doc_id), text_hash ROWS UNBOUNDED PRECEDING) AS cum
  FROM d JOIN parts USING (domain, lang, source))
SELECT doc_id, domain, lang, source, tokens, leaf_budget,
  (whole + CASE WHEN rest > 0 AND cum <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM ordered
"""

_TERMS = (
    r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
)

ORACLES["op13_ranked_search"] = f"""
WITH d AS (SELECT doc_id, {_TERMS} FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term),
q AS (SELECT item_id, {_TERMS} FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
parts AS (
  SELECT item_id, doc_id, times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // terms)))) AS part
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM parts GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
