"""Named queries and the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

#: The transaction log as a table expression; see sources.lake.txn.
CTES = {
    "txn": """
txn AS (
  SELECT id, t, amount, card, device, email, label, t // 86400 AS day,
         CASE WHEN t < 18 * 86400 THEN 'train' WHEN t < 24 * 86400 THEN 'valid' WHEN t < 31 * 86400 THEN 'test' END AS split
  FROM (
    SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS t, CAST(value AS DECIMAL(18,2)) AS amount,
           CAST(user_id AS VARCHAR) AS card, json_extract_string(props, '$.k') AS device, event_type AS email,
           CAST((event_id * 7919 + user_id) % 31 = 0 AS INTEGER) AS label
    FROM events))""",
    "gappy": """
gappy AS (SELECT * REPLACE (CASE WHEN CAST(device AS INTEGER) % 4 = 0 THEN device END AS device, (t // 3600) * 3600 AS t) FROM txn)""",
    "feat": """
feat AS (
  SELECT *,
    count(*) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING) AS card_txn_1h,
    count(*) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS card_txn_24h,
    coalesce(sum(amount) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), 0) AS card_amt_24h,
    CASE WHEN device IS NOT NULL AND card IS NOT NULL THEN CAST(t = min(t) OVER (PARTITION BY card, device) AS INTEGER) END AS card_new_device
  FROM txn)""",
    "scored": """
scored AS (
  SELECT *, 2 * CAST(amount >= 150 AS INTEGER) + 2 * CAST(card_txn_1h >= 1 AS INTEGER) + CAST(card_txn_24h >= 4 AS INTEGER)
           + CAST(card_amt_24h + amount >= 300 AS INTEGER) + CAST(coalesce(card_new_device, 0) = 1 AND amount >= 100 AS INTEGER) AS points,
    round(1 / (1 + exp(-(-4.5 + 0.5 * ln(1 + card_txn_24h) + 0.012 * CAST(amount AS DOUBLE) + 0.8 * coalesce(card_new_device, 0)))), 6) AS p
  FROM feat)""",
    "priced": """
priced AS (
  SELECT *, p * (CAST(amount AS DOUBLE) + 20) AS e_approve, (1 - p) * (0.25 * CAST(amount AS DOUBLE) + 10) AS e_decline,
         7 + p * (1 - 0.9::DOUBLE) * (CAST(amount AS DOUBLE) + 20) + (1 - p) * 2 AS e_review,
         points + least(greatest(CAST(amount AS DOUBLE), 0), 100000) / 100000 * 0.99 AS rules_score
  FROM scored)""",
    "decided": """
decided AS (
  SELECT *, CASE WHEN want_el AND seq_el <= 10 THEN 'review' WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS a_expected,
            CASE WHEN points >= 6 THEN 'decline' WHEN want_ru AND seq_ru <= 10 THEN 'review' ELSE 'approve' END AS a_rules,
            CASE WHEN p >= 0.5 THEN 'decline' WHEN want_cu AND seq_cu <= 10 THEN 'review' ELSE 'approve' END AS a_cutoff
  FROM (
    SELECT *, sum(CAST(want_el AS INTEGER)) OVER (PARTITION BY day ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS seq_el,
              sum(CAST(want_ru AS INTEGER)) OVER (PARTITION BY day ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS seq_ru,
              sum(CAST(want_cu AS INTEGER)) OVER (PARTITION BY day ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS seq_cu
    FROM (
      SELECT *, least(e_approve, e_decline) - e_review > 0.5 AND least(e_approve, e_decline) - e_review > 0 AS want_el,
                points >= 3 AND points < 6 AS want_ru, p >= 0.1 AND p < 0.5 AS want_cu
      FROM priced)))""",
    "acts": """
acts AS (
  SELECT id, t, day, split, amount, label, card, device, email, p, points, 'expected loss' AS policy, a_expected AS action FROM decided
  UNION ALL SELECT id, t, day, split, amount, label, card, device, email, p, points, 'rules', a_rules FROM decided
  UNION ALL SELECT id, t, day, split, amount, label, card, device, email, p, points, 'cut-offs', a_cutoff FROM decided
  UNION ALL SELECT id, t, day, split, amount, label, card, device, email, p, points, 'approve all', 'approve' FROM decided)""",
}

_NEEDS = {"txn": (), "gappy": ("txn",), "feat": ("txn",), "scored": ("feat",), "priced": ("scored",), "decided": ("priced",), "acts": ("decided",)}


def _closed(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for n in names:
        for m in [*_closed(_NEEDS[n]), n]:
            if m not in out:
                out.append(m)
    return out


#: Realised cost of actions on labelled amounts, as a list of aggregates.
COSTS_SQL = """
  round(sum(CASE WHEN label = 1 AND action = 'approve' THEN amount + 20 WHEN label = 1 AND action = 'review' THEN (1 - 0.9::DOUBLE) * (CAST(amount AS DOUBLE) + 20) ELSE 0 END)
    + sum(CASE WHEN label = 0 AND action = 'decline' THEN 0.25 * CAST(amount AS DOUBLE) + 10 ELSE 0 END)
    + 7 * count(*) FILTER (action = 'review') + 2 * count(*) FILTER (action = 'review' AND label = 0), 4) AS total_cost,
  round(sum(CASE WHEN label = 1 AND action = 'approve' THEN amount + 20 WHEN label = 1 AND action = 'review' THEN (1 - 0.9::DOUBLE) * (CAST(amount AS DOUBLE) + 20) ELSE 0 END), 4) AS missed_fraud_cost,
  round(sum(CASE WHEN label = 0 AND action = 'decline' THEN 0.25 * CAST(amount AS DOUBLE) + 10 ELSE 0 END), 4) AS declined_legit_cost,
  CAST(7 * count(*) FILTER (action = 'review') AS DOUBLE) AS review_cost,
  CAST(2 * count(*) FILTER (action = 'review' AND label = 0) AS DOUBLE) AS review_delay_cost,
  round(CAST(coalesce(sum(amount) FILTER (label = 1), 0) AS DOUBLE), 4) AS fraud_value,
  round(sum(CASE WHEN label = 1 AND action = 'decline' THEN CAST(amount AS DOUBLE) WHEN label = 1 AND action = 'review' THEN 0.9 * CAST(amount AS DOUBLE) ELSE 0 END), 4) AS fraud_value_caught,
  count(*) FILTER (action = 'decline') AS declines, count(*) FILTER (action = 'decline' AND label = 0) AS declined_legit,
  count(*) FILTER (action = 'review') AS reviews, count(*) FILTER (action = 'review' AND label = 1) AS reviewed_fraud,
  count(*) FILTER (action = 'approve' AND label = 1) AS approved_fraud,
  round(sum(CASE WHEN label = 1 AND action = 'decline' THEN CAST(amount AS DOUBLE) WHEN label = 1 AND action = 'review' THEN 0.9 * CAST(amount AS DOUBLE) ELSE 0 END)
    / nullif(CAST(coalesce(sum(amount) FILTER (label = 1), 0) AS DOUBLE), 0), 6) AS fraud_value_caught_share"""


def sql(body: str, *ctes: str, more: str = "") -> str:
    parts = [CTES[n].strip() for n in _closed(ctes)] + ([more.strip()] if more.strip() else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def query(name: str, text: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if text is not None:
            SQL[name] = text
        return f

    return add
