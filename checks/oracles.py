"""SQL counterparts of the registered queries, over the given tables."""

from __future__ import annotations

_FIXTURES = """
plans(id, name, price_cents, billing_cycle, api_limit, is_active) AS (VALUES
  (1, 'hobby', 0, 'monthly', 2500, TRUE), (2, 'team', 3750, 'monthly', 18000, TRUE),
  (3, 'studio', 11250, 'monthly', NULL, TRUE), (4, 'fleet', 71880, 'annual', NULL, TRUE),
  (5, 'team-2019', 2640, 'monthly', 7500, FALSE)),
tenants AS (SELECT c_custkey AS id, c_name AS name, lower(replace(c_name, '#', '-')) AS slug,
  CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
  CASE WHEN c_custkey % 10 = 9 THEN TIMESTAMP '1999-06-30 17:00:00' END AS deleted_at
  FROM customer),
users AS (SELECT 2 * t.id + n AS id, t.id AS tenant_id,
  'user' || n || '@' || t.slug || '.example' AS email,
  CASE (t.id + n) % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'member' ELSE 'viewer' END AS role,
  t.created_at, CAST(NULL AS TIMESTAMP) AS deleted_at
  FROM tenants t, (VALUES (0), (1)) v(n)),
subscriptions AS (
  SELECT 2 * c_custkey AS id, c_custkey AS tenant_id, 1 + c_custkey % 4 AS plan_id,
    CASE WHEN c_custkey % 8 <= 4 THEN 'active' WHEN c_custkey % 8 = 5 THEN 'trialing'
         WHEN c_custkey % 8 = 6 THEN 'past_due' ELSE 'cancelled' END AS status,
    TIMESTAMP '2024-01-01 00:00:00' AS current_period_start,
    CAST(DATE '2024-01-25' + CAST(c_custkey % 14 AS INTEGER) AS TIMESTAMP) AS current_period_end,
    CASE WHEN c_custkey % 8 = 7 THEN TIMESTAMP '2024-01-20 00:00:00' END AS cancelled_at,
    CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM customer
  UNION ALL
  SELECT 2 * c_custkey + 1, c_custkey, 2, 'cancelled', TIMESTAMP '1995-01-01 00:00:00',
    TIMESTAMP '1995-07-01 00:00:00', TIMESTAMP '1995-06-15 00:00:00',
    CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP)
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT 2 * c_custkey + 1, c_custkey, 1 + c_custkey % 4, 'trialing', TIMESTAMP '2024-01-01 00:00:00',
    CAST(DATE '2024-01-25' + CAST(c_custkey % 14 AS INTEGER) AS TIMESTAMP), NULL,
    CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP)
  FROM customer WHERE c_custkey % 24 = 5),
invoices AS (SELECT o_orderkey AS id, o_custkey AS tenant_id,
  CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 2 * o_custkey + 1 ELSE 2 * o_custkey END
    AS subscription_id,
  CAST(round(o_totalprice * 100) AS INTEGER) AS amount_cents,
  CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE
    CASE o_orderkey % 3 WHEN 0 THEN 'void' WHEN 1 THEN 'uncollectible' ELSE 'draft' END END AS status,
  CAST(o_orderdate AS DATE) + 7 AS due_date,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 4 AS INTEGER)) END
    AS paid_at,
  o_orderdate AS created_at
  FROM orders),
requests AS (SELECT user_id AS tenant_id, ts AS requested_at,
  '/api/v1/' || event_type || '?e=' || event_id AS url FROM events),
buckets AS (SELECT tenant_id, date_trunc('hour', requested_at) AS recorded_at,
  split_part(split_part(url, '?', 1), '#', 1) AS endpoint, CAST(count(*) AS INTEGER) AS event_count
  FROM requests GROUP BY 1, 2, 3),
usage AS (SELECT (tenant_id * 1000 + datediff('hour', TIMESTAMP '2024-01-01 00:00:00', recorded_at)) * 1000
  + ascii(substr(endpoint, 9, 1)) AS id, * FROM buckets),
audit_log AS (
  SELECT id, 'invoices' AS table_name, id AS row_id, 'system' AS changed_by, 'open' AS old_status,
    status AS new_status, coalesce(paid_at, created_at + INTERVAL 10 DAY) AS changed_at
  FROM invoices WHERE status IN ('paid', 'void', 'uncollectible')
  UNION ALL
  SELECT 1000000000 + id, 'subscriptions', id, 'system', 'active', status,
    coalesce(cancelled_at, TIMESTAMP '2024-01-15 00:00:00')
  FROM subscriptions WHERE id % 2 = 0 AND status IN ('past_due', 'cancelled')),
changes AS (SELECT c_custkey AS tenant_id, 2 * c_custkey + 1 AS subscription_id,
  CASE WHEN c_custkey % 30 = 0 THEN 99 ELSE 2 END AS old_plan_id,
  CASE WHEN c_custkey % 30 = 3 THEN 99 WHEN c_custkey % 4 = 1 THEN 5 ELSE 1 + c_custkey % 4 END
    AS new_plan_id,
  CASE WHEN c_custkey % 30 = 9 THEN TIMESTAMP '1995-05-25 00:00:00'
       ELSE CAST(DATE '1995-06-01' + CAST(c_custkey % 29 AS INTEGER) AS TIMESTAMP) END AS effective_at,
  TIMESTAMP '1995-06-01 00:00:00' AS period_start,
  CASE WHEN c_custkey % 30 = 6 THEN TIMESTAMP '1995-06-01 00:00:00'
       ELSE CAST(DATE '1995-06-28' + CAST(c_custkey % 5 AS INTEGER) AS TIMESTAMP) END AS period_end
  FROM customer WHERE c_custkey % 3 = 0),
priced AS (SELECT c.*, o.price_cents AS old_price, n.price_cents AS new_price,
  o.billing_cycle AS old_cycle, n.billing_cycle AS new_cycle,
  datediff('day', CAST(period_start AS DATE), CAST(period_end AS DATE)) AS days_in_cycle,
  greatest(datediff('day', CAST(effective_at AS DATE), CAST(period_end AS DATE)), 1) AS days_remaining
  FROM changes c LEFT JOIN plans o ON o.id = c.old_plan_id LEFT JOIN plans n ON n.id = c.new_plan_id),
judged AS (SELECT *, CASE WHEN old_price IS NULL THEN 'old plan not found'
  WHEN new_price IS NULL THEN 'new plan not found'
  WHEN days_in_cycle <= 0 THEN 'period end is not after period start'
  WHEN days_remaining > days_in_cycle THEN 'effective before period start' END AS reject_reason
  FROM priced),
rates AS (SELECT *,
  (CAST(old_price AS HUGEINT) * 20000000000000000 + days_in_cycle) // (2 * days_in_cycle) AS old_rate_e16,
  (CAST(new_price AS HUGEINT) * 20000000000000000 + days_in_cycle) // (2 * days_in_cycle) AS new_rate_e16
  FROM judged WHERE reject_reason IS NULL),
amounts AS (SELECT *,
  CAST(old_rate_e16 * days_remaining // 10000000000000000 AS INTEGER) AS credit_cents,
  CAST((new_rate_e16 * days_remaining + 9999999999999999) // 10000000000000000 AS INTEGER) AS charge_cents
  FROM rates),
versions AS (
  SELECT id AS row_id, created_at AS version_at, 0 AS version_no,
    CASE WHEN status = 'draft' THEN 'draft' ELSE 'open' END AS status FROM invoices
  UNION ALL
  SELECT id, created_at + INTERVAL 1 DAY, 1,
    CASE WHEN status = 'draft' THEN 'draft' ELSE 'open' END FROM invoices
  UNION ALL
  SELECT id, coalesce(paid_at, created_at + INTERVAL 10 DAY), 2, status FROM invoices)
"""


def _sql(query: str) -> str:
    return f"WITH {_FIXTURES.strip()}\n{query.strip()}"


_MONEY = "CAST({0} / 100.0 AS DECIMAL(18,2))"


def _dollars(cents: str) -> str:
    return _MONEY.format(cents)


_AS_OF = "TIMESTAMP '2024-01-28 00:00:00'"

_HISTORY_FROM = """
FROM tenants t LEFT JOIN subscriptions s ON s.tenant_id = t.id LEFT JOIN plans p ON p.id = s.plan_id
LEFT JOIN invoices i ON i.subscription_id = s.id WHERE t.deleted_at IS NULL
"""

REPORTS = {
    "revenue_by_month": f"""
SELECT t.id AS tenant_id, t.name AS tenant_name, t.slug AS tenant_slug, p.name AS plan_name,
  p.billing_cycle, CAST(date_trunc('month', i.created_at) AS TIMESTAMP) AS billing_month,
  count(i.id) AS invoice_count, CAST(sum(i.amount_cents) AS BIGINT) AS total_cents,
  {_dollars('sum(i.amount_cents)')} AS total_dollars
FROM invoices i JOIN subscriptions s ON s.id = i.subscription_id JOIN plans p ON p.id = s.plan_id
JOIN tenants t ON t.id = i.tenant_id
WHERE i.status = 'paid' AND t.deleted_at IS NULL GROUP BY ALL""",
    "revenue_for_month": f"""
SELECT t.name AS tenant_name, p.name AS plan_name, CAST(sum(i.amount_cents) AS BIGINT) AS total_cents,
  {_dollars('sum(i.amount_cents)')} AS total_dollars
FROM invoices i JOIN subscriptions s ON s.id = i.subscription_id JOIN plans p ON p.id = s.plan_id
JOIN tenants t ON t.id = i.tenant_id
WHERE i.status = 'paid' AND t.deleted_at IS NULL
  AND date_trunc('month', i.created_at) = DATE '1997-05-01' GROUP BY ALL""",
    "lifetime_revenue": f"""
SELECT t.id AS tenant_id, t.name AS tenant_name, count(i.id) AS total_invoices_paid,
  CAST(sum(i.amount_cents) AS BIGINT) AS lifetime_cents,
  {_dollars('sum(i.amount_cents)')} AS lifetime_dollars,
  min(i.paid_at) AS first_payment_at, max(i.paid_at) AS most_recent_payment_at
FROM invoices i JOIN tenants t ON t.id = i.tenant_id
WHERE i.status = 'paid' AND t.deleted_at IS NULL GROUP BY t.id, t.name""",
    "outstanding_balance": f"""
SELECT t.id AS tenant_id, t.name AS tenant_name, t.slug AS tenant_slug, t.created_at AS tenant_since,
  p.name AS plan_name, p.billing_cycle, p.price_cents AS plan_price_cents,
  {_dollars('p.price_cents')} AS plan_price_dollars, p.api_limit, s.status AS subscription_status,
  s.current_period_start AS period_start, s.current_period_end AS period_end,
  CAST(datediff('day', CAST({_AS_OF} AS DATE), CAST(s.current_period_end AS DATE)) AS INTEGER)
    AS days_remaining_in_period,
  CAST(coalesce(sum(i.amount_cents), 0) AS BIGINT) AS outstanding_cents,
  {_dollars('coalesce(sum(i.amount_cents), 0)')} AS outstanding_dollars,
  count(i.id) AS open_invoice_count
FROM tenants t JOIN subscriptions s ON s.tenant_id = t.id AND s.status IN ('active', 'trialing')
JOIN plans p ON p.id = s.plan_id
LEFT JOIN invoices i ON i.subscription_id = s.id AND i.status = 'open'
WHERE t.deleted_at IS NULL GROUP BY ALL""",
    "renewals_due": f"""
SELECT t.name AS tenant_name, p.name AS plan_name, p.price_cents AS renewal_amount_cents,
  {_dollars('p.price_cents')} AS renewal_amount_dollars, s.current_period_end AS renews_at,
  CAST(datediff('day', CAST({_AS_OF} AS DATE), CAST(s.current_period_end AS DATE)) AS INTEGER)
    AS days_until_renewal
FROM tenants t JOIN subscriptions s ON s.tenant_id = t.id AND s.status = 'active'
JOIN plans p ON p.id = s.plan_id
WHERE t.deleted_at IS NULL AND s.current_period_end BETWEEN {_AS_OF} AND {_AS_OF} + INTERVAL 7 DAY""",
    "plan_mrr": f"""
SELECT p.name AS plan_name, p.billing_cycle, {_dollars('p.price_cents')} AS price_dollars,
  count(s.id) AS active_tenant_count,
  CASE p.billing_cycle WHEN 'monthly' THEN {_dollars('sum(p.price_cents)')}
    WHEN 'annual' THEN {_dollars('((2 * sum(p.price_cents) + 12) // 24)')} END AS mrr_contribution_dollars
FROM subscriptions s JOIN plans p ON p.id = s.plan_id JOIN tenants t ON t.id = s.tenant_id
WHERE s.status = 'active' AND t.deleted_at IS NULL
GROUP BY p.id, p.name, p.billing_cycle, p.price_cents""",
    "invoice_history": f"""
SELECT t.id AS tenant_id, t.name AS tenant_name, s.id AS subscription_id, s.status AS subscription_status,
  p.name AS plan_name, p.billing_cycle, s.current_period_start AS period_start,
  s.current_period_end AS period_end, i.id AS invoice_id, i.amount_cents,
  {_dollars('i.amount_cents')} AS amount_dollars, i.status AS invoice_status, i.due_date, i.paid_at,
  i.created_at AS invoice_created_at {_HISTORY_FROM}""",
    "tenant_invoice_history": f"""
SELECT s.id AS subscription_id, s.status AS subscription_status, p.name AS plan_name, i.id AS invoice_id,
  {_dollars('i.amount_cents')} AS amount_dollars, i.status AS invoice_status, i.due_date, i.paid_at,
  i.created_at AS invoice_created_at {_HISTORY_FROM} AND t.id = 12""",
    "outstanding_invoices": f"""
SELECT t.name AS tenant_name, p.name AS plan_name, i.id AS invoice_id,
  {_dollars('i.amount_cents')} AS amount_dollars, i.status AS invoice_status, i.due_date,
  CAST(datediff('day', i.due_date, CAST({_AS_OF} AS DATE)) AS INTEGER) AS days_overdue
FROM invoices i JOIN subscriptions s ON s.id = i.subscription_id JOIN plans p ON p.id = s.plan_id
JOIN tenants t ON t.id = i.tenant_id
WHERE i.status IN ('open', 'past_due') AND t.deleted_at IS NULL""",
    "usage_by_cycle": f"""
SELECT t.id AS tenant_id, t.name AS tenant_name, s.id AS subscription_id, p.name AS plan_name, p.api_limit,
  e.endpoint, s.current_period_start AS period_start, s.current_period_end AS period_end,
  CAST(sum(e.event_count) AS BIGINT) AS total_calls,
  CAST(p.api_limit - sum(e.event_count) AS BIGINT) AS calls_remaining,
  {_dollars('((2 * sum(e.event_count) * 10000 + p.api_limit) // (2 * p.api_limit))')}
    AS pct_limit_consumed,
  {_AS_OF} AS last_refreshed_at
FROM usage e JOIN tenants t ON t.id = e.tenant_id
JOIN subscriptions s ON s.tenant_id = e.tenant_id AND e.recorded_at >= s.current_period_start
  AND e.recorded_at < s.current_period_end
JOIN plans p ON p.id = s.plan_id
WHERE t.deleted_at IS NULL AND s.status IN ('active', 'trialing', 'past_due')
GROUP BY t.id, t.name, s.id, p.name, p.api_limit, e.endpoint, s.current_period_start, s.current_period_end""",
}

USAGE = {
    "meter_hourly": "SELECT tenant_id, recorded_at, endpoint, event_count FROM usage",
    "normalise_endpoint": """
SELECT url, split_part(split_part(url, '?', 1), '#', 1) AS endpoint FROM requests""",
}

PRORATION = {
    "prorate": """
SELECT tenant_id, subscription_id, CAST(old_plan_id AS BIGINT) AS old_plan_id,
  CAST(new_plan_id AS BIGINT) AS new_plan_id, effective_at, period_start, period_end,
  CAST(days_remaining AS INTEGER) AS days_remaining, CAST(days_in_cycle AS INTEGER) AS days_in_cycle,
  CAST(old_rate_e16 AS VARCHAR) AS old_rate_e16, CAST(new_rate_e16 AS VARCHAR) AS new_rate_e16,
  credit_cents, charge_cents, charge_cents - credit_cents AS net_cents,
  old_cycle <> new_cycle AS warn_cycle_mismatch
FROM amounts""",
    "prorate_exact": """
SELECT tenant_id, subscription_id,
  CAST(CAST(old_price AS BIGINT) * days_remaining // days_in_cycle AS INTEGER) AS credit_cents,
  CAST((CAST(new_price AS BIGINT) * days_remaining + days_in_cycle - 1) // days_in_cycle AS INTEGER)
    AS charge_cents
FROM rates""",
    "prorate_rejects": """
SELECT tenant_id, subscription_id, CAST(old_plan_id AS BIGINT) AS old_plan_id,
  CAST(new_plan_id AS BIGINT) AS new_plan_id, effective_at, period_start, period_end, reject_reason
FROM judged WHERE reject_reason IS NOT NULL""",
    "proration_invoices": """
SELECT tenant_id, subscription_id, effective_at, charge_cents - credit_cents AS amount_cents
FROM amounts WHERE charge_cents >= credit_cents""",
    "proration_credits": """
SELECT tenant_id, subscription_id, effective_at, credit_cents - charge_cents AS credit_cents
FROM amounts WHERE charge_cents < credit_cents""",
}


_BROKEN = """
b_plans AS (SELECT *, TIMESTAMP '1994-01-01 00:00:00' AS created_at FROM plans
  UNION ALL SELECT 6, 'weekly', -1, 'weekly', 0, TRUE, TIMESTAMP '1994-01-01 00:00:00'
  UNION ALL SELECT 7, 'studio', 100, 'monthly', NULL, TRUE, TIMESTAMP '1994-01-01 00:00:00'),
b_tenants AS (SELECT id, CASE WHEN id % 50 = 11 THEN NULL ELSE name END AS name,
  CASE id % 50 WHEN 7 THEN upper(slug) WHEN 17 THEN 'same-slug' ELSE slug END AS slug, created_at,
  CASE WHEN id % 50 = 13 THEN created_at - INTERVAL 1 DAY ELSE deleted_at END AS deleted_at FROM tenants),
b_users AS (SELECT id, CASE WHEN id % 40 = 21 THEN -1 ELSE tenant_id END AS tenant_id,
  CASE WHEN id % 40 = 9 THEN replace(email, '@', '-')
       WHEN id % 40 IN (12, 13) THEN 'same@' || tenant_id || '.example' ELSE email END AS email,
  CASE WHEN id % 40 = 5 THEN 'superuser' ELSE role END AS role, created_at, deleted_at FROM users),
b_subscriptions AS (SELECT id, tenant_id, CASE WHEN id % 40 = 16 THEN 99 ELSE plan_id END AS plan_id,
  CASE WHEN id % 40 = 2 THEN 'expired' WHEN id % 2 = 1 AND tenant_id % 30 = 0 THEN 'active' ELSE status END
    AS status, current_period_start,
  CASE WHEN id % 40 = 6 THEN current_period_start - INTERVAL 1 DAY ELSE current_period_end END
    AS current_period_end,
  CASE WHEN id % 40 = 10 THEN created_at - INTERVAL 1 DAY
       WHEN id % 2 = 1 AND tenant_id % 30 = 0 THEN NULL ELSE cancelled_at END AS cancelled_at,
  created_at FROM subscriptions),
b_invoices AS (SELECT id, tenant_id, CASE WHEN id % 100 = 8 THEN -5 ELSE subscription_id END AS subscription_id,
  CASE WHEN id % 100 = 1 THEN -1 ELSE amount_cents END AS amount_cents,
  CASE WHEN id % 100 = 2 THEN 'overdue' ELSE status END AS status,
  CASE WHEN id % 100 = 6 THEN CAST(created_at AS DATE) - 1 ELSE due_date END AS due_date,
  CASE id % 100 WHEN 3 THEN NULL WHEN 4 THEN created_at - INTERVAL 1 DAY ELSE paid_at END AS paid_at,
  CASE WHEN id % 100 = 9 THEN NULL ELSE created_at END AS created_at FROM invoices),
b_usage AS (SELECT id, tenant_id,
  CASE WHEN tenant_id % 20 = 4 AND hour(recorded_at) = 6 THEN recorded_at + INTERVAL 1 MINUTE
       ELSE recorded_at END AS recorded_at,
  CASE WHEN tenant_id % 20 = 5 AND hour(recorded_at) = 7 THEN '/api/v1/same' ELSE endpoint END AS endpoint,
  CASE WHEN tenant_id % 20 = 3 AND hour(recorded_at) = 5 THEN 0 ELSE event_count END AS event_count FROM usage),
b_audit AS (SELECT id, CASE WHEN id % 100 = 6 THEN 'users' ELSE table_name END AS table_name, row_id,
  changed_by, old_status, CASE WHEN id % 100 = 7 THEN old_status ELSE new_status END AS new_status, changed_at
  FROM audit_log),
b_changes AS (SELECT tenant_id || '|' || subscription_id AS id, tenant_id, subscription_id, old_plan_id,
  CASE WHEN tenant_id % 45 = 12 THEN old_plan_id ELSE new_plan_id END AS new_plan_id, effective_at,
  CASE WHEN tenant_id % 45 = 15 THEN days_in_cycle + 1 ELSE days_remaining END AS days_remaining, days_in_cycle,
  CASE WHEN tenant_id % 45 = 21 THEN -1 ELSE credit_cents END AS credit_cents, charge_cents,
  CASE WHEN tenant_id % 45 = 18 THEN 0 ELSE charge_cents - credit_cents END AS net_cents,
  effective_at AS created_at FROM amounts)
"""

_BROKEN_TABLES = {
    "tenants": "b_tenants", "plans": "b_plans", "users": "b_users", "subscriptions": "b_subscriptions",
    "invoices": "b_invoices", "api_usage_events": "b_usage", "billing_audit_log": "b_audit",
    "plan_change_events": "b_changes",
}
# Table, rule, what breaks it.
_ROW_FAULTS = [
    ("tenants", "slug_format", "NOT regexp_matches(slug, '^[a-z0-9]+(-[a-z0-9]+)*$')"),
    ("tenants", "deleted_after_created", "deleted_at <= created_at"),
    ("plans", "price_not_negative", "price_cents < 0"),
    ("plans", "billing_cycle_known", "billing_cycle NOT IN ('monthly', 'annual')"),
    ("plans", "api_limit_positive", "api_limit <= 0"),
    ("users", "email_format", r"NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$', 'i')"),
    ("users", "role_known", "role NOT IN ('admin', 'member', 'viewer')"),
    ("users", "deleted_after_created", "deleted_at <= created_at"),
    ("subscriptions", "status_known", "status NOT IN ('active', 'cancelled', 'past_due', 'trialing')"),
    ("subscriptions", "period_order", "current_period_end <= current_period_start"),
    ("subscriptions", "cancelled_has_date",
     "(status = 'cancelled' AND cancelled_at IS NULL) OR (status <> 'cancelled' AND cancelled_at IS NOT NULL)"),
    ("subscriptions", "cancelled_after_created", "cancelled_at < created_at"),
    ("invoices", "amount_not_negative", "amount_cents < 0"),
    ("invoices", "status_known", "status NOT IN ('draft', 'open', 'paid', 'void', 'uncollectible')"),
    ("invoices", "paid_has_date",
     "(status = 'paid' AND paid_at IS NULL) OR (status <> 'paid' AND paid_at IS NOT NULL)"),
    ("invoices", "paid_after_created", "paid_at < created_at"),
    ("invoices", "due_after_created", "due_date < CAST(created_at AS DATE)"),
    ("api_usage_events", "count_positive", "event_count <= 0"),
    ("api_usage_events", "on_the_hour", "minute(recorded_at) <> 0 OR second(recorded_at) <> 0"),
    ("billing_audit_log", "table_known", "table_name NOT IN ('subscriptions', 'invoices')"),
    ("billing_audit_log", "status_differs", "old_status = new_status"),
    ("plan_change_events", "plans_differ", "old_plan_id = new_plan_id"),
    ("plan_change_events", "days_in_range", "days_remaining <= 0 OR days_remaining > days_in_cycle"),
    ("plan_change_events", "cycle_positive", "days_in_cycle <= 0"),
    ("plan_change_events", "credit_not_negative", "credit_cents < 0"),
    ("plan_change_events", "charge_not_negative", "charge_cents < 0"),
    ("plan_change_events", "net_is_difference", "net_cents <> charge_cents - credit_cents"),
]
_REQUIRED = {
    "tenants": "id name slug created_at",
    "plans": "id name price_cents billing_cycle is_active created_at",
    "users": "id tenant_id email role created_at",
    "subscriptions": "id tenant_id plan_id status current_period_start current_period_end created_at",
    "invoices": "id tenant_id subscription_id amount_cents status due_date created_at",
    "api_usage_events": "id tenant_id recorded_at endpoint event_count",
    "billing_audit_log": "id table_name row_id changed_by old_status new_status changed_at",
    "plan_change_events": "id tenant_id subscription_id old_plan_id new_plan_id effective_at days_remaining "
                          "days_in_cycle credit_cents charge_cents net_cents created_at",
}
_ROW_FAULTS += [
    (table, f"{column}_not_null", f"{column} IS NULL")
    for table, columns in _REQUIRED.items() for column in columns.split()
]
# Table, rule, key, extra condition.
_KEY_FAULTS = [
    (table, "primary_key", {"invoices": "id, created_at", "api_usage_events": "id, recorded_at"}.get(table, "id"), "")
    for table in _REQUIRED
] + [
    ("tenants", "slug_unique", "slug", ""), ("plans", "name_unique", "name", ""),
    ("users", "email_unique_in_tenant", "tenant_id, email", ""),
    ("subscriptions", "one_active_per_tenant", "tenant_id", "status = 'active' AND"),
    ("api_usage_events", "bucket_unique", "tenant_id, recorded_at, endpoint", ""),
]
_REFERENCES = [
    ("users", "tenant_id", "tenants"), ("subscriptions", "tenant_id", "tenants"),
    ("subscriptions", "plan_id", "plans"), ("invoices", "tenant_id", "tenants"),
    ("invoices", "subscription_id", "subscriptions"), ("api_usage_events", "tenant_id", "tenants"),
    ("plan_change_events", "tenant_id", "tenants"),
    ("plan_change_events", "subscription_id", "subscriptions"),
    ("plan_change_events", "old_plan_id", "plans"), ("plan_change_events", "new_plan_id", "plans"),
]


def _key_text(key: str) -> str:
    # Whole seconds only, in the form Spark prints.
    parts = [
        f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c.endswith("_at") else f"CAST({c} AS VARCHAR)"
        for c in key.split(", ")
    ]
    return f"concat_ws('|', {', '.join(parts)})"


def _violations(table: str) -> list[tuple[str, str]]:
    """Rule name and the SQL of its violations ``rule, key, rows`` for one faulty table."""
    source = _BROKEN_TABLES[table]
    primary = next(key for t, rule, key, _ in _KEY_FAULTS if t == table and rule == "primary_key")
    found = [
        (rule, f"SELECT '{rule}' AS rule, {_key_text(primary)} AS key, CAST(1 AS BIGINT) AS rows "
               f"FROM {source} WHERE {fault}")
        for t, rule, fault in _ROW_FAULTS if t == table
    ]
    found += [
        (rule, f"SELECT '{rule}', {_key_text(key)}, count(*) FROM {source} WHERE {extra} "
               f"{' AND '.join(f'{c} IS NOT NULL' for c in key.split(', '))} GROUP BY {key} HAVING count(*) > 1")
        for t, rule, key, extra in _KEY_FAULTS if t == table
    ]
    found += [
        (f"{column}_exists",
         f"SELECT '{column}_exists', CAST({column} AS VARCHAR), count(*) FROM {source} WHERE {column} IS NOT NULL "
         f"AND {column} NOT IN (SELECT id FROM {_BROKEN_TABLES[target]}) GROUP BY {column}")
        for t, column, target in _REFERENCES if t == table
    ]
    return found


def _broken_sql(query: str) -> str:
    return f"WITH {_FIXTURES.strip()},\n{_BROKEN.strip()}\n{query.strip()}"


def _violation_list(*tables: str) -> str:
    return _broken_sql("\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, * FROM ({sql})" for table in tables for _, sql in _violations(table)
    ))


def _summary(*tables: str) -> str:
    return _broken_sql("\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS violations FROM ({sql})"
        for table in tables for rule, sql in _violations(table)
    ))


_OPENED = "CASE WHEN status = 'draft' THEN 'draft' ELSE 'open' END"

AUDIT = {
    "status_changes": f"""
SELECT 'invoices' AS table_name, id AS row_id, 'system' AS changed_by, {_OPENED} AS old_status,
  status AS new_status, {_AS_OF} AS changed_at
FROM invoices WHERE {_OPENED} <> status""",
    "status_changes_from_feed": """
SELECT 'invoices' AS table_name, row_id, 'system' AS changed_by, old_status, status AS new_status,
  version_at AS changed_at
FROM (SELECT *, lag(status) OVER (PARTITION BY row_id ORDER BY version_at, version_no) AS old_status FROM versions)
WHERE old_status <> status""",
    "status_changes_hot_row": """
SELECT 'invoices' AS table_name, row_id, 'system' AS changed_by, old_status, status AS new_status, version_at AS changed_at
FROM (SELECT *, lag(status) OVER (PARTITION BY row_id ORDER BY version_at, version_no) AS old_status FROM (
  SELECT status, CASE WHEN row_id % 3 = 0 THEN 0 ELSE row_id END AS row_id,
    CASE WHEN row_id % 3 = 0 THEN row_id * 3 + version_no ELSE version_no END AS version_no,
    CASE WHEN row_id % 3 = 0 THEN TIMESTAMP '1996-03-01 00:00:00' + to_seconds(row_id % 50) ELSE version_at END AS version_at FROM versions))
WHERE old_status <> status""",
    "audit_history": """
SELECT * FROM audit_log WHERE table_name = 'subscriptions' AND row_id = 12""",
    "audit_between": """
SELECT * FROM audit_log
WHERE changed_at >= TIMESTAMP '1997-03-01 00:00:00' AND changed_at < TIMESTAMP '1997-05-15 00:00:00'""",
    "audit_since": """
SELECT * FROM audit_log
WHERE changed_at > TIMESTAMP '1998-01-01 00:00:00' AND table_name IN ('invoices', 'subscriptions')""",
    "next_watermark": """
SELECT max(changed_at) AS watermark FROM audit_log
WHERE changed_at > TIMESTAMP '1998-01-01 00:00:00' AND table_name IN ('invoices', 'subscriptions')""",
}

RULES = {
    "rule_summary": _summary(*_BROKEN_TABLES),
    "rule_violations": _violation_list(*_BROKEN_TABLES),
    "rule_violations_kept": _violation_list("invoices"),
    "ledger_edits": _broken_sql("""
SELECT o.id, CASE WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS edit
FROM invoices o LEFT JOIN (SELECT * FROM b_invoices WHERE id % 100 <> 50) n ON n.id = o.id
WHERE n.id IS NULL OR (o.tenant_id, o.subscription_id, o.amount_cents, o.due_date, o.created_at)
  IS DISTINCT FROM (n.tenant_id, n.subscription_id, n.amount_cents, n.due_date, n.created_at)"""),
    "retired_plan_subscriptions": _sql("""
SELECT s.id AS subscription_id, s.tenant_id, s.plan_id, p.name AS plan_name, s.created_at
FROM (SELECT id, tenant_id, plan_id + 1 AS plan_id, created_at FROM subscriptions) s
JOIN plans p ON p.id = s.plan_id
WHERE NOT p.is_active AND s.created_at >= TIMESTAMP '1994-06-01 00:00:00'"""),
    "rollup_violations": _sql(f"""
SELECT 'usage_by_cycle' AS table_name, 'primary_key' AS rule, subscription_id || '|' || endpoint AS key, CAST(2 AS BIGINT) AS rows
FROM ({REPORTS['usage_by_cycle']}) WHERE subscription_id % 4 = 0"""),
    "overlapping_periods_hot": _sql("""
SELECT tenant_id, subscription_id, period_start, period_end, busy_until
FROM (SELECT *, max(period_end) OVER (PARTITION BY tenant_id ORDER BY period_start, subscription_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until
  FROM (SELECT CASE WHEN id % 3 = 0 THEN 0 ELSE tenant_id END AS tenant_id, id AS subscription_id,
      CASE WHEN id % 2 = 0 THEN created_at ELSE TIMESTAMP '1996-03-01 00:00:00' END AS period_start,
      CASE WHEN id % 2 = 0 THEN created_at ELSE TIMESTAMP '1996-03-01 00:00:00' END + to_days(CAST(id % 9 AS INTEGER)) AS period_end FROM invoices)
  WHERE period_end > period_start)
WHERE busy_until > period_start"""),
    "overlapping_periods": _sql("""
SELECT tenant_id, subscription_id, period_start, period_end, busy_until
FROM (SELECT tenant_id, id AS subscription_id, current_period_start AS period_start, current_period_end AS period_end,
  max(current_period_end) OVER (PARTITION BY tenant_id ORDER BY current_period_start, id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until FROM subscriptions)
WHERE busy_until > period_start"""),
}

LEDGER = {
    "out_of_range_rows": """
SELECT id, created_at FROM invoices
WHERE created_at < TIMESTAMP '1996-01-01 00:00:00' OR created_at >= TIMESTAMP '2001-01-01 00:00:00'""",
    "missing_months": """
SELECT t.table_name, strftime(m, '%Y-%m') AS month
FROM (VALUES ('invoices'), ('api_usage_events')) t(table_name),
  generate_series(TIMESTAMP '2001-01-01 00:00:00', TIMESTAMP '2024-04-01 00:00:00', INTERVAL 1 MONTH) g(m)
WHERE (t.table_name, strftime(m, '%Y-%m')) NOT IN (
  SELECT 'invoices', strftime(created_at, '%Y-%m') FROM invoices
  UNION SELECT 'api_usage_events', strftime(recorded_at, '%Y-%m') FROM usage)""",
    "ledger_between": """
SELECT * FROM invoices
WHERE created_at >= TIMESTAMP '1997-02-10 00:00:00' AND created_at < TIMESTAMP '1997-04-01 00:00:00'""",
}

_INVOICES_OF = "SELECT id, status, amount_cents, created_at FROM invoices"

LOOKUPS = {
    "users_of": "SELECT * FROM users WHERE tenant_id = 12",
    "active_users_of": """
SELECT id, email, role FROM (
  SELECT *, CASE WHEN id % 2 = 0 THEN created_at + INTERVAL 1 DAY END AS left_at FROM users)
WHERE tenant_id = 12 AND left_at IS NULL""",
    "subscriptions_of": "SELECT * FROM subscriptions WHERE tenant_id = 12",
    "active_subscriptions_of": "SELECT * FROM subscriptions WHERE tenant_id = 12 AND status = 'active'",
    "subscriptions_ending": """
SELECT * FROM subscriptions WHERE status IN ('active', 'trialing') AND current_period_end
  BETWEEN TIMESTAMP '2024-01-26 00:00:00' AND TIMESTAMP '2024-02-01 00:00:00'""",
    "subscriptions_on": "SELECT * FROM subscriptions WHERE plan_id = 3",
    "plan_subscribers": """
SELECT CAST(p.id AS BIGINT) AS plan_id, p.name AS plan_name, p.is_active, s.status,
  count(s.id) AS subscriptions
FROM plans p LEFT JOIN subscriptions s ON s.plan_id = p.id GROUP BY p.id, p.name, p.is_active, s.status""",
    "invoices_of": f"{_INVOICES_OF} WHERE tenant_id = 12",
    "open_invoices_of": f"{_INVOICES_OF} WHERE tenant_id = 12 AND status = 'open'",
    "subscription_invoices_of": f"{_INVOICES_OF} WHERE subscription_id = 24",
    "reported_invoices_between": f"""{_INVOICES_OF}
WHERE created_at >= TIMESTAMP '1996-03-05 00:00:00' AND created_at < TIMESTAMP '1996-09-01 00:00:00'
  AND status NOT IN ('void', 'draft')""",
    "plan_changes_of": """
SELECT tenant_id, subscription_id, days_remaining, credit_cents, charge_cents FROM (
  SELECT tenant_id, subscription_id, CAST(days_remaining AS INTEGER) AS days_remaining, credit_cents,
    charge_cents FROM amounts) WHERE tenant_id = 12""",
    "usage_between": """
SELECT tenant_id, recorded_at, endpoint, event_count FROM usage WHERE tenant_id = 12
  AND recorded_at >= TIMESTAMP '2024-01-05 00:00:00' AND recorded_at < TIMESTAMP '2024-01-20 00:00:00'""",
    "platform_usage_between": """
SELECT tenant_id, recorded_at, endpoint, event_count FROM usage
WHERE recorded_at >= TIMESTAMP '2024-01-05 00:00:00' AND recorded_at < TIMESTAMP '2024-01-20 00:00:00'""",
}


_FLEET = """
e AS (SELECT 'db-' || user_id % 4 AS instance, ts, event_id, user_id, event_type,
  CAST(round(value * 100) AS BIGINT) AS cents, CAST(date_trunc('week', ts) AS TIMESTAMP) AS snapshot_ts,
  CASE event_id % 4 WHEN 1 THEN 'idle' WHEN 2 THEN 'idle in transaction' ELSE 'active' END AS state
  FROM events),
stats AS (SELECT instance, snapshot_ts, 'SELECT ' || event_type || ' ' || event_id % 20 AS query,
  count(*) AS calls, CAST(sum(cents) AS BIGINT) AS cents, max(cents) AS top,
  CAST(sum(cents) AS BIGINT) * 100 // count(*) AS mean4 FROM e GROUP BY 1, 2, 3),
log AS (SELECT * FROM e WHERE event_id % 10 <> 9),
table_io AS (SELECT instance, snapshot_ts, 't_' || event_id % 12 AS relname,
  CAST(sum(cents) AS BIGINT) AS heap_blks_hit, CAST(sum(event_id % 500) AS BIGINT) AS heap_blks_read
  FROM e GROUP BY 1, 2, 3),
table_stats AS (SELECT 'db-' || o_custkey % 4 AS instance, TIMESTAMP '2024-01-28 00:00:00' AS snapshot_ts,
  CASE WHEN o_orderkey % 11 = 0 THEN 'tenants' ELSE 'invoices_' || strftime(o_orderdate, '%Y_%m') END AS relname,
  count(*) FILTER (o_orderstatus <> 'P') AS n_live_tup,
  count(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 3 = 0) AS n_dead_tup,
  min(CAST(o_orderdate AS TIMESTAMP)) AS last_autovacuum, max(CAST(o_orderdate AS TIMESTAMP)) AS last_vacuum,
  CAST(sum(o_orderkey % 7) AS BIGINT) AS idx_scan, count(*) FILTER (o_orderkey % 5 = 0) AS seq_scan
  FROM orders GROUP BY 1, 2, 3),
c AS (SELECT 'db-' || c_custkey % 4 AS instance, TIMESTAMP '2024-01-28 00:00:00' AS snapshot_ts,
  c_custkey AS k FROM customer),
standbys AS (SELECT instance, snapshot_ts, 'standby_' || k AS application_name,
  CASE WHEN k % 17 = 0 THEN 'catchup' ELSE 'streaming' END AS state,
  CASE WHEN k % 13 = 0 THEN 'async' ELSE 'sync' END AS sync_state,
  CASE WHEN k % 5 > 0 THEN k * 37 % 8000 END AS replay_lag_ms, 5000 - k % 5000 AS lag_bytes,
  k * 11 % 3000 AS write_lag_ms, k * 23 % 5000 AS flush_lag_ms FROM c),
replication AS (SELECT *, CASE WHEN state <> 'streaming' THEN 'not streaming'
  WHEN sync_state <> 'sync' THEN 'not synchronous' WHEN coalesce(replay_lag_ms, 0) < 1000 THEN 'healthy'
  WHEN replay_lag_ms <= 5000 THEN 'watch' ELSE 'investigate' END AS status FROM standbys),
sessions AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS taken_at FROM e)
"""


def _fleet_sql(query: str) -> str:
    return f"WITH {_FLEET.strip()}\n{query.strip()}"


def _whole_percent(part: str, whole: str) -> str:
    return _dollars(f"((20000 * CAST({part} AS HUGEINT) + {whole}) // nullif(2 * ({whole}), 0))")


_ROUNDED_MEAN = _dollars("((mean4 + 50) // 100)")
_TOP = "QUALIFY rank <= 10"


def _ranked(order: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY instance, snapshot_ts ORDER BY {order}) AS INTEGER) AS rank"


_CACHE = _whole_percent("sum(heap_blks_hit)", "sum(heap_blks_hit) + sum(heap_blks_read)")
_DEAD = _whole_percent("n_dead_tup", "n_live_tup + n_dead_tup")
_VIA_INDEX = _whole_percent("idx_scan", "seq_scan + idx_scan")

TELEMETRY = {
    "statement_top_total": f"""
SELECT instance, snapshot_ts, {_ranked('cents DESC, query')}, query, calls, {_dollars('cents')} AS total_ms,
  {_ROUNDED_MEAN} AS mean_ms,
  {_whole_percent('cents', 'sum(cents) OVER (PARTITION BY instance, snapshot_ts)')} AS pct_of_total
FROM stats {_TOP}""",
    "statement_top_mean": f"""
SELECT instance, snapshot_ts, {_ranked('mean4 DESC, query')}, query, calls, {_ROUNDED_MEAN} AS mean_ms,
  {_dollars('top')} AS max_ms FROM stats WHERE calls > 5 {_TOP}""",
    "statement_top_spread": f"""
SELECT instance, snapshot_ts,
  {_ranked('(top * 100 - mean4 + 50) // 100 DESC, query')}, query, calls, {_ROUNDED_MEAN} AS mean_ms,
  {_dollars('top')} AS max_ms, {_dollars('((top * 100 - mean4 + 50) // 100)')} AS variance_ms
FROM stats WHERE calls > 3 {_TOP}""",
    "parse_slow_log": """
SELECT date_trunc('second', ts) AS logged_at, CAST(event_id AS INTEGER) AS pid, 'u' || user_id AS user,
  'billing' AS db, 'api' AS app, '10.0.1.4' AS client, CAST(cents / 100.0 AS DECIMAL(18,3)) AS duration_ms,
  CASE event_id % 10 WHEN 5 THEN NULL WHEN 7 THEN 'execute q1' ELSE 'statement' END AS kind,
  CASE WHEN event_id % 10 <> 5 THEN 'SELECT ' || event_type END AS statement
FROM log WHERE cents > 20000 AND event_id % 100 <> 8""",
    "parse_slow_log_over_lines": """
SELECT instance, date_trunc('second', ts) AS logged_at, CAST(event_id AS INTEGER) AS pid, 'u' || user_id AS user,
  'billing' AS db, 'api' AS app, '10.0.1.4' AS client, CAST(cents / 100.0 AS DECIMAL(18,3)) AS duration_ms,
  CASE event_id % 10 WHEN 5 THEN NULL WHEN 7 THEN 'execute q1' ELSE 'statement' END AS kind,
  CASE WHEN event_id % 10 <> 5 THEN 'SELECT ' || event_type || repeat(chr(10) || 'AND n = ' || event_id, event_id % 12) END AS statement
FROM log WHERE cents > 20000 AND event_id % 100 <> 8""",
    "unparsed_durations": "SELECT 'duration: unknown' AS line, count(*) AS lines FROM log WHERE event_id % 100 = 8 GROUP BY 1",
    "longest_statements": """
SELECT instance, taken_at AS snapshot_ts, event_id AS pid, epoch_us(taken_at) - epoch_us(ts) AS running_micros,
  event_type AS query FROM sessions WHERE state = 'active'""",
    "slowest_statements": """
SELECT date_trunc('second', ts) AS logged_at, CAST(event_id AS INTEGER) AS pid,
  CAST(cents / 100.0 AS DECIMAL(18,3)) AS duration_ms,
  CASE WHEN event_id % 10 <> 5 THEN 'SELECT ' || event_type END AS statement
FROM log WHERE cents > 20000 AND event_id % 100 <> 8 ORDER BY cents DESC, 1, 2, 4 LIMIT 20""",
    "cache_hit_ratio": f"""
SELECT *, CASE WHEN cache_hit_ratio > 99 THEN 'healthy' WHEN cache_hit_ratio >= 95 THEN 'acceptable'
  ELSE 'investigate' END AS status
FROM (SELECT instance, snapshot_ts, CAST(sum(heap_blks_hit) AS BIGINT) AS cache_hits,
  CAST(sum(heap_blks_read) AS BIGINT) AS disk_reads, {_CACHE} AS cache_hit_ratio FROM table_io GROUP BY 1, 2)""",
    "cache_hit_by_table": f"""
SELECT instance, snapshot_ts, {_ranked('heap_blks_read DESC, relname')}, relname, heap_blks_hit,
  heap_blks_read, {_whole_percent('heap_blks_hit', 'heap_blks_hit + heap_blks_read')} AS cache_hit_ratio
FROM table_io {_TOP}""",
    "index_usage": f"""
SELECT instance, snapshot_ts, relname, seq_scan, idx_scan, {_VIA_INDEX} AS pct_via_index,
  {_VIA_INDEX} > 90 AS healthy FROM table_stats""",
    "unused_indexes": """
SELECT instance, snapshot_ts, 't_' || k % 12 AS table_name, 'ix_' || k AS index_name,
  CAST(0 AS BIGINT) AS idx_scan, k * 8192 AS index_bytes FROM c WHERE k % 3 = 0""",
    "replication_health": "SELECT * FROM replication",
    "retained_log": """
SELECT instance, snapshot_ts, 'slot_' || k AS slot_name, k % 6 > 0 AS active, 5000 - k % 5001 AS retained_bytes,
  k % 6 = 0 AND k % 5001 < 5000 AS at_risk FROM c""",
    "sessions_by_state": """
SELECT instance, taken_at AS snapshot_ts, state, count(*) AS sessions FROM sessions GROUP BY ALL""",
    "idle_in_transaction": """
SELECT instance, taken_at AS snapshot_ts, event_id AS pid, 'u' || user_id AS usename, 'api' AS application_name,
  state, epoch_us(taken_at) - epoch_us(ts) AS idle_micros, event_type AS query
FROM sessions WHERE state = 'idle in transaction'""",
    "pool_pressure": """
SELECT instance, taken_at AS snapshot_ts, count(*) AS sessions, 90 AS pool_limit, count(*) > 90 AS over_limit
FROM sessions GROUP BY 1, 2""",
    "dead_rows": f"""
SELECT *, CASE WHEN pct_dead < 10 OR pct_dead IS NULL THEN 'healthy' WHEN pct_dead <= 20 THEN 'monitor'
  ELSE 'investigate' END AS status
FROM (SELECT instance, snapshot_ts, 'public' AS schemaname, relname, n_live_tup, n_dead_tup, {_DEAD} AS pct_dead,
  last_autovacuum, last_vacuum
  FROM table_stats WHERE relname LIKE 'invoices%')""",
    "health_check": f"""
, cache AS (SELECT instance, snapshot_ts, {_CACHE} AS cache_hit_ratio FROM table_io GROUP BY 1, 2),
lag AS (SELECT instance, snapshot_ts, max(coalesce(replay_lag_ms, 0)) AS replay_lag_ms,
  count(*) FILTER (status <> 'healthy') AS unhealthy_standbys FROM replication GROUP BY 1, 2),
idle AS (SELECT instance, taken_at AS snapshot_ts,
  count(*) FILTER (state = 'idle in transaction') AS idle_in_transaction FROM sessions GROUP BY 1, 2),
dead AS (SELECT instance, snapshot_ts, n_live_tup, n_dead_tup FROM table_stats
  WHERE relname = 'invoices_1997_05')
SELECT * FROM cache FULL JOIN lag USING (instance, snapshot_ts) FULL JOIN idle USING (instance, snapshot_ts)
FULL JOIN dead USING (instance, snapshot_ts)""",
}


_TOPIC = """CASE table_name WHEN 'invoices' THEN 'billing.invoice.created'
  WHEN 'subscriptions' THEN 'billing.subscription.changed' END"""
_ISO = "strftime(changed_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_PAYLOAD = f"""
SELECT {_TOPIC} AS topic, CAST(id AS VARCHAR) AS audit_log_id, table_name, CAST(row_id AS VARCHAR) AS row_id,
  old_status, new_status, {_ISO} AS changed_at, changed_by, strftime(changed_at, '%Y-%m-%d') AS event_date
FROM audit_log"""
_EVENT = f"""
SELECT {_TOPIC} AS topic, CAST(id AS VARCHAR) AS key,
  '{{"audit_log_id":"' || id || '","table_name":"' || table_name || '","row_id":"' || row_id
  || '","old_status":"' || old_status || '","new_status":"' || new_status || '","changed_at":"' || {_ISO}
  || '","changed_by":"' || changed_by || '"}}' AS value FROM audit_log"""
_MONTH = "strftime(created_at, '%Y-%m')"

LAKE = {
    "load_tables": """
SELECT 'tenants' AS table_name, id || '|' || name || '|' || slug AS content FROM tenants
UNION ALL SELECT 'plans', id || '|' || name || '|' || price_cents || '|' || coalesce(CAST(api_limit AS VARCHAR), '-') FROM plans
UNION ALL SELECT 'users', id || '|' || tenant_id || '|' || email || '|' || role FROM users
UNION ALL SELECT 'subscriptions', id || '|' || tenant_id || '|' || plan_id || '|' || status || '|'
  || strftime(current_period_end, '%Y-%m-%d') || '|' || coalesce(strftime(cancelled_at, '%Y-%m-%d'), '-') FROM subscriptions
UNION ALL SELECT 'invoices', id || '|' || tenant_id || '|' || subscription_id || '|' || amount_cents || '|' || status || '|'
  || strftime(due_date, '%Y-%m-%d') || '|' || coalesce(strftime(paid_at, '%Y-%m-%d'), '-') || '|' || strftime(created_at, '%Y-%m-%d') FROM invoices
UNION ALL SELECT 'api_usage_events', tenant_id || '|' || strftime(recorded_at, '%Y-%m-%d %H') || '|' || endpoint || '|' || event_count FROM usage
UNION ALL SELECT 'billing_audit_log', id || '|' || table_name || '|' || row_id || '|' || old_status || '|' || new_status || '|'
  || strftime(changed_at, '%Y-%m-%d') FROM audit_log
UNION ALL SELECT 'plan_change_events', tenant_id || '|' || subscription_id || '|' || credit_cents || '|' || charge_cents FROM amounts""",
    "usage_by_cycle_months": REPORTS["usage_by_cycle"],
    "upsert_usage": """
SELECT tenant_id, recorded_at, endpoint,
  CASE WHEN tenant_id % 2 = 0 THEN event_count ELSE event_count + 1 END AS event_count FROM usage""",
    "upsert_usage_undated": """
SELECT CASE WHEN id % 7 > 0 THEN 'table' ELSE 'undated' END AS place, tenant_id,
  CASE WHEN id % 7 > 0 THEN recorded_at END AS recorded_at, endpoint || '#' || id AS endpoint,
  CAST(event_count + (id % 2 = 0)::INTEGER AS INTEGER) AS event_count FROM usage""",
    "refresh_from_usage": f"""
{REPORTS['usage_by_cycle']}""",
    "refresh_usage_by_cycle": f"""
{REPORTS['usage_by_cycle']}""",
    "ledger_between_months": f"""
SELECT id, amount_cents, created_at, {_MONTH} AS month FROM invoices
WHERE created_at >= TIMESTAMP '1996-02-10 00:00:00' AND created_at < TIMESTAMP '1996-05-01 00:00:00'""",
    "recover_default": f"""
SELECT id, {_MONTH} AS month,
  CASE WHEN {_MONTH} BETWEEN '1996-01' AND '1999-02' THEN 'ledger' ELSE 'quarantine' END AS place FROM invoices""",
    "migrate_to_monthly": f"""
SELECT {_MONTH} AS month, count(*) AS source_rows, count(*) AS target_rows,
  CAST(sum(amount_cents) AS BIGINT) AS source_total, CAST(sum(amount_cents) AS BIGINT) AS target_total,
  TRUE AS matches FROM invoices GROUP BY 1""",
    "archive_months": f"""
SELECT {_MONTH} AS month, count(*) AS rows, count(*) AS archived_rows,
  CAST(sum(amount_cents) AS BIGINT) AS total, CAST(sum(amount_cents) AS BIGINT) AS archived_total,
  TRUE AS removable FROM invoices WHERE created_at < TIMESTAMP '1997-01-01 00:00:00' GROUP BY 1""",
    "write_plan_changes": """
SELECT tenant_id, subscription_id, CAST(days_remaining AS INTEGER) AS days_remaining, credit_cents, charge_cents,
  charge_cents - credit_cents AS net_cents FROM amounts""",
    "route_events": f"SELECT id, table_name, {_TOPIC} AS topic FROM audit_log",
    "to_event": _EVENT,
    "parse_event": _PAYLOAD,
    "land_raw": _PAYLOAD,
    "verify_landing": f"SELECT count(*) AS events, max({_ISO}) AS newest_changed_at, TRUE AS caught_up FROM audit_log",
    "pipeline_in_slices": _PAYLOAD,
    "land_raw_rejects": f"""
SELECT {_TOPIC} AS topic, CAST(id AS VARCHAR) AS key, 'landed' AS outcome FROM audit_log WHERE id % 7 > 2
UNION ALL SELECT {_TOPIC}, CAST(id AS VARCHAR),
  CASE id % 7 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'no date' ELSE 'no id' END FROM audit_log WHERE id % 7 <= 2""",
    "land_raw_rejects_replayed": f"""
SELECT {_TOPIC} AS topic, CAST(id AS VARCHAR) AS key, '{{' AS value, 'unreadable' AS reason, '0' AS batch FROM audit_log WHERE id % 3 = 0""",
    "archive_null_ids": f"""
SELECT CASE WHEN id % 5 > 0 THEN id END AS id, tenant_id, amount_cents, {_MONTH} AS month
FROM invoices, generate_series(1, CASE WHEN id % 15 = 0 THEN 2 ELSE 1 END) WHERE created_at < TIMESTAMP '1997-01-01 00:00:00'""",
    "reconcile_swapped": f"""
SELECT {_MONTH} AS month, count(*) AS source_rows, count(*) AS target_rows, CAST(sum(amount_cents) AS BIGINT) AS source_total,
  CAST(sum(amount_cents) AS BIGINT) AS target_total, min(id) % 2 <> 0 OR arg_min(amount_cents, id) = arg_max(amount_cents, id) AS matches
FROM invoices GROUP BY 1""",
    "archive_late_rows": f"""
SELECT id, amount_cents, {_MONTH} AS month FROM invoices WHERE created_at < TIMESTAMP '1997-01-01 00:00:00'""",
    "recover_default_conflicts": f"""
SELECT id, amount_cents, 'ledger' AS place FROM invoices WHERE {_MONTH} = '1996-03'
UNION ALL SELECT id, amount_cents + 1, 'quarantine' FROM invoices WHERE {_MONTH} = '1996-03' AND id % 5 = 0""",
    "ranges_by_month": f"""
SELECT 'offset end' AS range, id, {_MONTH} AS month FROM invoices
WHERE created_at >= TIMESTAMP '1997-01-05 00:00:00' AND created_at < TIMESTAMP '1997-02-01 04:00:00'
UNION ALL SELECT 'one month', id, {_MONTH} FROM invoices WHERE {_MONTH} = '1996-01'
UNION ALL SELECT 'outside', id, {_MONTH} FROM invoices WHERE {_MONTH} NOT BETWEEN '1993-01' AND '1997-12'""",
    "missing_months_stored": """
SELECT 'invoices' AS table_name, strftime(m, '%Y-%m') AS month
FROM generate_series(TIMESTAMP '1990-01-01 00:00:00', TIMESTAMP '2024-04-01 00:00:00', INTERVAL 1 MONTH) g(m)
WHERE strftime(m, '%Y-%m') NOT IN (SELECT strftime(created_at, '%Y-%m') FROM invoices)""",
    "meter_stream_completed": "SELECT tenant_id, recorded_at, endpoint, event_count FROM usage",
    "land_raw_replayed": f"""
SELECT {_TOPIC} AS topic, strftime(changed_at, '%Y-%m-%d') AS event_date, count(*) AS events
FROM audit_log GROUP BY 1, 2""",
    "dedupe_events": _EVENT,
    "meter_hourly_stream": """
SELECT tenant_id, recorded_at, endpoint, event_count FROM usage
WHERE recorded_at + INTERVAL 1 HOUR
  <= (SELECT date_trunc('millisecond', max(requested_at)) FROM requests) - INTERVAL 1 HOUR""",
    "status_changes_stream": """
SELECT 'invoices' AS table_name, row_id, old_status, status AS new_status, version_at AS changed_at
FROM (SELECT *, lag(status) OVER (PARTITION BY row_id ORDER BY version_at, version_no) AS old_status FROM versions)
WHERE old_status <> status""",
    "status_changes_table": """
SELECT 'invoices' AS table_name, row_id, old_status, status AS new_status, version_at AS changed_at
FROM (SELECT *, lag(status) OVER (PARTITION BY row_id ORDER BY version_at, version_no) AS old_status FROM versions)
WHERE old_status <> status""",
    "status_changes_late": """
SELECT 'invoices' AS table_name, row_id, old_status, status AS new_status, version_at AS changed_at
FROM (SELECT *, lag(status) OVER (PARTITION BY row_id ORDER BY version_at, version_no) AS old_status FROM versions)
WHERE old_status <> status""",
}


def oracle_sql() -> dict[str, str]:
    plain = (REPORTS, USAGE, PRORATION, AUDIT, LEDGER, LOOKUPS, LAKE)
    return {
        **{name: _sql(query) for group in plain for name, query in group.items()},
        **RULES,
        **{name: _fleet_sql(query) for name, query in TELEMETRY.items()},
    }
