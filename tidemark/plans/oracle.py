"""DuckDB SQL with the results every catalogue query must give.

Written from the definitions, not from the Spark code: plain joins, plain
``count(DISTINCT ...)`` and whole-table windows.  Shared parts are CTEs.
"""

from __future__ import annotations

import re

def _health_daily(usage: str, standing: str | None = None) -> str:
    """Health per account and day of the usage; each figure is a plain window over the days.

    ``standing`` names intervals of payment_status and status; without it those of today count for every day.
    """
    first, last = f"(SELECT min(event_date) FROM {usage})", f"(SELECT max(event_date) FROM {usage})"
    frame = "OVER (PARTITION BY account_id ORDER BY d ROWS BETWEEN {} PRECEDING AND {})".format
    near = "OVER (PARTITION BY s.account_id ORDER BY s.d RANGE BETWEEN INTERVAL {} DAY PRECEDING AND CURRENT ROW)".format

    def moved(column: str) -> str:
        return (f"SELECT account_id, greatest(CAST({column} AS DATE), {first}) AS d, count(*) AS n, count(*) FILTER (severity = 'critical') AS p "
                f"FROM ticket WHERE CAST({column} AS DATE) <= {last} GROUP BY ALL")

    upto = frame("UNBOUNDED", "CURRENT ROW")
    known = """JOIN (SELECT account_id, payment_status FROM health) USING (account_id)
            JOIN (SELECT account_id, status FROM subscription) USING (account_id)""" if standing is None else f"""
            LEFT JOIN {standing} h ON h.account_id = x.account_id AND h.valid_from <= x.d AND (h.valid_to IS NULL OR h.valid_to > x.d)"""
    account = "account_id" if standing is None else "x.account_id"
    payment = "payment_status" if standing is None else "coalesce(payment_status, 'Good Standing')"
    return f"""WITH spine AS (SELECT account_id, CAST(unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS DATE) AS d FROM account),
        used AS (SELECT account_id, event_date AS d, count(*) AS e FROM {usage} GROUP BY ALL),
        seen AS (SELECT account_id, d, max(u7) AS u7, max(u30) AS u30 FROM (
            SELECT s.account_id, s.d, count(DISTINCT user_id) {near(6)} AS u7, count(DISTINCT user_id) {near(29)} AS u30
            FROM spine s LEFT JOIN (SELECT DISTINCT account_id, user_id, event_date FROM {usage}) u
                ON u.account_id = s.account_id AND u.event_date = s.d) GROUP BY ALL),
        opened AS ({moved('created_at')}), closed AS ({moved('resolved_at')}),
        days AS (SELECT account_id, d, coalesce(e, 0) AS e, coalesce(o.n, 0) - coalesce(c.n, 0) AS n, coalesce(o.p, 0) - coalesce(c.p, 0) AS p
            FROM spine LEFT JOIN used USING (account_id, d) LEFT JOIN opened o USING (account_id, d) LEFT JOIN closed c USING (account_id, d)),
        summed AS (SELECT account_id, d, coalesce(sum(e) {frame(6, 'CURRENT ROW')}, 0)::BIGINT AS e7, coalesce(sum(e) {frame(13, '7 PRECEDING')}, 0)::BIGINT AS prior7,
            sum(e) {frame(29, 'CURRENT ROW')} AS e30, (sum(n) {upto})::BIGINT AS open_now, (sum(p) {upto})::BIGINT AS p1_now FROM days)
        SELECT account_id, strftime(d, '%Y-%m-%d') AS date_key, u7 AS active_users_7d, u30 AS active_users_30d,
        e7 AS total_events_7d, CASE WHEN prior7 > 0 THEN round((e7 - prior7) / prior7, 4) END AS event_growth_wow,
        open_now AS open_tickets_count, p1_now AS unresolved_p1_tickets, payment_status, health_score,
        round(greatest(0.02, (100.0 - health_score) / 100.0)::DOUBLE, 3) AS churn_risk_score FROM
        (SELECT {account} AS account_id, x.* EXCLUDE (account_id), {payment} AS payment_status,
        round(greatest(0.0, 100.0 - CASE WHEN e30 < 50 THEN 30.0 WHEN e30 < 200 THEN 15.0 ELSE 0.0 END
            - least(25.0, open_now * 5.0) - least(30.0, p1_now * 15.0)
            - CASE WHEN {payment} <> 'Good Standing' THEN 25.0 ELSE 0.0 END
            - CASE WHEN status = 'past_due' THEN 20.0 ELSE 0.0 END)::DOUBLE, 1) AS health_score
        FROM (SELECT * FROM summed JOIN seen USING (account_id, d)) x {known})"""


# Name -> SQL; a CTE may use those above it.
CTES = {
    "plan": """SELECT * FROM (VALUES ('Starter',299,5,50000),('Professional',999,25,250000),
        ('Enterprise',3499,100,1000000),('Enterprise Plus',7499,500,5000000))
        t(plan_name, base_mrr, seat_limit, event_quota)""",
    "small_plan": """SELECT * FROM (VALUES ('Starter',2300),('Professional',2400),('Enterprise',2500),
        ('Enterprise Plus',2600)) t(plan_name, event_quota)""",
    "account": """SELECT c_custkey AS account_id, c_name AS company_name, c_mktsegment AS industry,
        CASE WHEN c_acctbal < 0 THEN '1-50' WHEN c_acctbal < 2500 THEN '51-200'
             WHEN c_acctbal < 7500 THEN '201-1000' ELSE '1000+' END AS company_size,
        r_name AS region, n_name AS csm_owner,
        TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
        CASE WHEN c_custkey % 10 < 6 THEN 'healthy' WHEN c_custkey % 10 < 8 THEN 'churn_risk'
             WHEN c_custkey % 10 = 8 THEN 'expansion_ready' ELSE 'underutilized' END AS cohort
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "subscription": """SELECT c_custkey AS subscription_id, c_custkey AS account_id, plan_name,
        TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS start_date,
        CASE WHEN c_acctbal < 0 THEN 'past_due' ELSE 'active' END AS status, base_mrr AS mrr
        FROM customer JOIN plan ON plan_name = CASE c_custkey % 4 WHEN 0 THEN 'Starter'
            WHEN 1 THEN 'Professional' WHEN 2 THEN 'Enterprise' ELSE 'Enterprise Plus' END""",
    "invoice": """SELECT o_orderkey AS invoice_id, o_custkey AS account_id,
        CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderdate + INTERVAL 15 DAY AS due_date,
        CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'failed'
             WHEN o_orderstatus = 'O' THEN 'open' ELSE 'paid' END AS status, o_orderdate FROM orders""",
    "billing": """SELECT invoice_id, account_id, amount, due_date,
        CASE WHEN status = 'paid' THEN o_orderdate + INTERVAL 10 DAY END AS paid_at, status,
        status = 'failed' OR (status = 'open' AND due_date < TIMESTAMP '1995-07-01') AS is_overdue FROM invoice""",
    "ticket_copy": """SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS account_id,
        CASE WHEN l_quantity >= 49 AND l_returnflag = 'A' THEN 'critical' WHEN l_quantity >= 49 AND l_returnflag = 'R' THEN 'high'
             WHEN l_linenumber % 2 = 1 THEN 'medium' ELSE 'low' END AS severity,
        CASE WHEN l_quantity < 49 OR (l_linestatus = 'F' AND l_shipdate >= o_orderdate) THEN 'resolved' ELSE 'open' END AS status,
        o_orderdate AS created_at,
        CASE WHEN l_quantity < 49 OR (l_linestatus = 'F' AND l_shipdate >= o_orderdate) THEN greatest(l_shipdate, o_orderdate) END AS resolved_at,
        l_partkey, l_suppkey, l_extendedprice, l_shipdate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "ticket": """SELECT ticket_id, account_id, severity, status, created_at, resolved_at FROM ticket_copy
        QUALIFY row_number() OVER (PARTITION BY ticket_id
            ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1""",
    "support": """SELECT *, CASE WHEN resolved_at IS NOT NULL THEN
            (epoch_us(resolved_at) - epoch_us(created_at)) / 3.6e9 END AS resolution_time_hours,
        (epoch_us(coalesce(resolved_at, TIMESTAMP '2001-12-31')) - epoch_us(created_at)) / 3.6e9 >
            CASE severity WHEN 'critical' THEN 12 WHEN 'high' THEN 24 WHEN 'medium' THEN 48 WHEN 'low' THEN 72
                 ELSE 48 END AS sla_breached FROM ticket""",
    "usage": """SELECT event_id AS usage_id, user_id // 3 AS account_id, user_id, event_type AS feature,
        ts AS event_timestamp, CAST(ts AS DATE) AS event_date FROM events""",
    "users": """SELECT user_id, user_id // 3 AS account_id,
        concat('user', user_id, '@Account', user_id // 3, '.example.com') AS email,
        CASE user_id % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'developer' ELSE 'viewer' END AS role,
        min(ts) AS created_at FROM events GROUP BY user_id""",
    "usage30": """SELECT account_id, count(*) AS events_last_30d, count(DISTINCT user_id) AS active_users_30d
        FROM usage WHERE event_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY account_id""",
    "support_acc": """SELECT account_id, count(*) AS total_tickets,
        count(*) FILTER (status = 'open') AS open_tickets,
        count(*) FILTER (severity = 'critical') AS critical_tickets,
        count(*) FILTER (severity = 'critical' AND status = 'open') AS critical_open_tickets,
        count(*) FILTER (sla_breached) AS sla_breached_count,
        round(100.0 - count(*) FILTER (sla_breached) / count(*) * 100.0, 2) AS sla_compliance_rate
        FROM support GROUP BY account_id""",
    "billing_acc": """SELECT account_id, bool_or(status = 'failed') AS has_failed,
        bool_or(is_overdue) AS has_open_overdue,
        CASE WHEN bool_or(status = 'failed') OR bool_or(is_overdue) THEN 'Failed / Overdue'
             ELSE 'Good Standing' END AS payment_status FROM billing GROUP BY account_id""",
    "joined": """SELECT a.*, s.plan_name AS plan, s.mrr, s.status AS sub_status,
        coalesce(u.events_last_30d, 0) AS events_last_30d, coalesce(u.active_users_30d, 0) AS active_users_30d,
        coalesce(t.open_tickets, 0) AS open_tickets, coalesce(t.critical_tickets, 0) AS critical_tickets,
        coalesce(t.sla_compliance_rate, 100.0) AS sla_compliance_rate,
        coalesce(b.payment_status, 'Good Standing') AS payment_status
        FROM account a LEFT JOIN subscription s USING (account_id) LEFT JOIN usage30 u USING (account_id)
        LEFT JOIN support_acc t USING (account_id) LEFT JOIN billing_acc b USING (account_id)""",
    "scored": """SELECT *, greatest(0.0, least(100.0, 100.0
        - CASE WHEN events_last_30d < 50 THEN 30.0 WHEN events_last_30d < 200 THEN 15.0 ELSE 0.0 END
        - least(25.0, open_tickets * 5.0) - least(30.0, critical_tickets * 15.0)
        - CASE WHEN payment_status <> 'Good Standing' THEN 25.0 ELSE 0.0 END
        - CASE WHEN sub_status = 'past_due' THEN 20.0 ELSE 0.0 END))::DOUBLE AS raw FROM joined""",
    "health": """SELECT account_id, company_name, industry, plan, mrr::DOUBLE AS mrr, csm_owner,
        round(raw, 1) AS health_score,
        CASE WHEN raw >= 75 THEN 'Healthy' WHEN raw >= 50 THEN 'At Risk' ELSE 'Critical' END AS health_tier,
        events_last_30d::BIGINT AS events_last_30d, active_users_30d::BIGINT AS active_users_30d,
        open_tickets::BIGINT AS open_tickets, critical_tickets::BIGINT AS critical_tickets,
        sla_compliance_rate::DOUBLE AS sla_compliance_rate, payment_status,
        round(greatest(0.02, (100.0 - round(raw, 1)) / 100.0)::DOUBLE, 3) AS churn_risk_score,
        round(least(0.95::DOUBLE, events_last_30d / 1000.0::DOUBLE * CASE WHEN raw >= 75 THEN 0.8 ELSE 0.2 END), 3)
            AS expansion_score,
        cohort = 'churn_risk' AS anomaly_detected, TIMESTAMP '2024-01-31' AS last_updated_at FROM scored""",
    "revenue": """SELECT epoch_us(TIMESTAMP '2024-01-31') AS id,
        s.active_mrr::DOUBLE AS total_mrr, (s.active_mrr * 12)::DOUBLE AS total_arr,
        b.paid::DOUBLE AS paid_invoices_amount, b.unpaid::DOUBLE AS unpaid_invoices_amount,
        s.active_accounts, s.past_due_accounts,
        CASE WHEN s.active_mrr > 0 THEN 100.0 ELSE 0.0 END::DOUBLE AS net_retention_rate,
        round(s.past_due_accounts / (SELECT count(*) FROM account) * 100.0, 2)::DOUBLE AS logo_churn_rate,
        round(s.past_due_mrr::DOUBLE / s.all_mrr * 100.0, 2)::DOUBLE AS revenue_churn_rate,
        0.0::DOUBLE AS expansion_rate, TIMESTAMP '2024-01-31' AS calculated_at
        FROM (SELECT sum(mrr) FILTER (status = 'active') AS active_mrr, sum(mrr) AS all_mrr,
                sum(mrr) FILTER (status = 'past_due') AS past_due_mrr,
                count(*) FILTER (status = 'active') AS active_accounts,
                count(*) FILTER (status = 'past_due') AS past_due_accounts FROM subscription) s,
             (SELECT sum(amount) FILTER (status = 'paid') AS paid, sum(amount) FILTER (status <> 'paid') AS unpaid
              FROM billing) b""",
    "scenario": """SELECT * EXCLUDE (shift), CASE WHEN annual_growth <= -1 THEN -1
            ELSE pow(1 + annual_growth, 1.0::DOUBLE / 12) - 1 END AS monthly_growth
        FROM (SELECT v.*, r.total_mrr AS starting_mrr, r.total_mrr * 12 AS starting_arr,
            (r.expansion_rate - r.revenue_churn_rate) / 100 + v.shift AS annual_growth
            FROM revenue r, (VALUES ('base', 0.0::DOUBLE, 'Base Case (Current Warehouse Trend)'),
            ('bull', 0.02::DOUBLE, 'Bull Case (Improved Growth)'),
            ('bear', -0.02::DOUBLE, 'Bear Case (Higher Pressure)')) v(scenario, shift, label))""",
    "projection": """SELECT scenario, m AS month_index, 'Month +' || m AS period,
        round(starting_mrr * pow(1 + monthly_growth, m), 2) AS mrr,
        round(starting_mrr * pow(1 + monthly_growth, m) * 12, 2) AS arr
        FROM scenario, (SELECT CAST(range AS INTEGER) AS m FROM range(1, 13))""",
    "fired_health": """SELECT concat('alt_health_', account_id) AS alert_id, account_id, 'CSM Alert' AS alert_type,
        'critical' AS severity,
        concat('Account health score deteriorated to ', health_score, ' (Critical tier).') AS trigger_reason,
        'open' AS status, csm_owner AS owner, TIMESTAMP '2024-01-31' AS created_at, company_name
        FROM health WHERE health_score < 50""",
    "fired_billing": """SELECT concat('alt_bill_', invoice_id) AS alert_id, account_id,
        'Payment Failure' AS alert_type, 'high' AS severity,
        concat('Invoice ', invoice_id, ' for $', format('{:,.2f}', amount::DOUBLE), ' failed to clear.')
            AS trigger_reason,
        'open' AS status, 'Finance Operations' AS owner, TIMESTAMP '2024-01-31' AS created_at, company_name,
        concat('Automated billing workflow triggered for $', amount) AS detail
        FROM billing JOIN account USING (account_id) WHERE status = 'failed'""",
    "fired_upsell": """SELECT concat('alt_upsell_', account_id) AS alert_id, account_id,
        'Upsell Recommendation' AS alert_type, 'medium' AS severity,
        concat('Account telemetry exceeded 85% of plan quota (', plan, '). Prime candidate for plan upgrade.')
            AS trigger_reason,
        'open' AS status, 'Account Executive Team' AS owner, TIMESTAMP '2024-01-31' AS created_at, company_name
        FROM health JOIN small_plan ON plan = plan_name WHERE events_last_30d * 10 >= event_quota * 0.85""",
    "fired_support": """SELECT concat('alt_sup_', account_id) AS alert_id, account_id,
        'Support Deterioration' AS alert_type, 'critical' AS severity,
        concat('Account has ', critical_tickets, ' unresolved critical support incidents.') AS trigger_reason,
        'open' AS status, csm_owner AS owner, TIMESTAMP '2024-01-31' AS created_at, company_name
        FROM health WHERE critical_tickets >= 2""",
    "alert": """SELECT * FROM fired_health UNION ALL SELECT * EXCLUDE (detail) FROM fired_billing
        UNION ALL SELECT * FROM fired_upsell UNION ALL SELECT * FROM fired_support""",
    "request": """SELECT concat('alt_bill_', o_orderkey) AS alert_id,
        CASE WHEN o_totalprice > 100000 THEN 'call first' END AS notes
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "acked": """SELECT a.* EXCLUDE (status), CASE WHEN r.alert_id IS NULL THEN a.status ELSE 'acknowledged' END AS status,
        CASE WHEN r.alert_id IS NOT NULL THEN TIMESTAMP '2024-02-01' END AS acknowledged_at, r.notes,
        r.alert_id IS NOT NULL AS hit FROM alert a LEFT JOIN request r ON a.alert_id = r.alert_id""",
    "labelled": """SELECT churn_risk_score AS score, CASE WHEN s.status = 'past_due' THEN 1 ELSE 0 END AS label
        FROM health JOIN subscription s USING (account_id)""",
    "matrix": """SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
        count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM labelled""",
    "yearly": """SELECT o_custkey AS account_id, CAST(year(o_orderdate) AS INTEGER) AS period,
        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS paid FROM orders GROUP BY 1, 2""",
    "spine": """SELECT account_id, CAST(period AS INTEGER) AS period FROM (SELECT DISTINCT account_id FROM yearly),
        (SELECT unnest(range((SELECT min(period) FROM yearly), (SELECT max(period) + 1 FROM yearly))) AS period)""",
    "ending": """SELECT account_id, period, coalesce(paid, 0)::DECIMAL(18,2) AS e,
        lag(coalesce(paid, 0)::DECIMAL(18,2)) OVER (PARTITION BY account_id ORDER BY period) AS prior
        FROM spine LEFT JOIN yearly USING (account_id, period)""",
    "movement": """SELECT account_id, period, b AS beginning_mrr,
        CASE WHEN b = 0 THEN e ELSE 0 END AS new_mrr, CASE WHEN b > 0 AND e > b THEN e - b ELSE 0 END AS expansion_mrr,
        CASE WHEN e > 0 AND e < b THEN b - e ELSE 0 END AS contraction_mrr,
        CASE WHEN e = 0 THEN b ELSE 0 END AS churn_mrr, e AS ending_mrr, e - b AS net_new_mrr,
        CASE WHEN prior IS NULL THEN 'opening' WHEN b = 0 AND e > 0 THEN 'new' WHEN b > 0 AND e = 0 THEN 'churn'
             WHEN e > b THEN 'expansion' WHEN e < b THEN 'contraction' ELSE 'unchanged' END AS change_type
        FROM (SELECT *, coalesce(prior, 0)::DECIMAL(18,2) AS b FROM ending)""",
    "month_paid": """SELECT DISTINCT o_custkey AS account_id,
        CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m FROM orders""",
    "month_churn": """SELECT CAST(p.m + 1 AS INTEGER) AS month_number, count(*) AS starting_accounts,
        count(*) FILTER (n.m IS NULL) AS churned_accounts,
        round(count(*) FILTER (n.m IS NULL) / count(*) * 100.0, 2) AS churn_pct
        FROM month_paid p LEFT JOIN month_paid n ON n.account_id = p.account_id AND n.m = p.m + 1
        WHERE p.m < (SELECT max(m) FROM month_paid) GROUP BY p.m""",
    "user_day": "SELECT DISTINCT account_id, user_id, event_date FROM usage",
    "order_usage": """SELECT o_custkey AS account_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS event_date
        FROM orders""",
    "health_daily_usage": _health_daily("usage"),
    "health_daily_orders": _health_daily("order_usage"),
    "health_drop": """SELECT account_id, date_key, previous_score, health_score,
        round((previous_score - health_score) / previous_score * 100.0, 2) AS drop_pct FROM
        (SELECT *, lag(health_score, 7) OVER (PARTITION BY account_id ORDER BY date_key) AS previous_score FROM health_daily_orders)
        WHERE previous_score > 0 AND (previous_score - health_score) / previous_score > 0.20""",
    "month_end": """SELECT account_id, last_day(m) AS day,
            CASE WHEN EXISTS (SELECT 1 FROM invoice WHERE invoice.account_id = a.account_id
                AND CAST(o_orderdate AS DATE) <= last_day(m) AND (invoice.status = 'failed'
                    OR (invoice.status = 'open' AND CAST(due_date AS DATE) < last_day(m)))) THEN 'Failed / Overdue' ELSE 'Good Standing' END AS payment_status,
            CASE WHEN CAST(start_date AS DATE) <= last_day(m) THEN status END AS status
        FROM (SELECT account_id, unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 MONTH)) AS m
            FROM account) a JOIN subscription USING (account_id)""",
    "standing": """SELECT account_id, payment_status, status, day AS valid_from, lead(day) OVER (PARTITION BY account_id ORDER BY day) AS valid_to
        FROM (SELECT *, lag((payment_status, coalesce(status, ''))) OVER (PARTITION BY account_id ORDER BY day) AS before FROM month_end)
        WHERE before IS NULL OR before <> (payment_status, coalesce(status, ''))""",
    "health_daily_known": _health_daily("order_usage", "standing"),
    "backlog": """SELECT ticket_id, account_id, created_at FROM (
            SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS account_id, o_orderdate AS created_at, l_returnflag, l_quantity,
                l_linestatus = 'F' AND l_shipdate >= o_orderdate AS resolved, l_partkey, l_suppkey, l_extendedprice, l_shipdate
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1)
        WHERE l_quantity >= 40 AND l_returnflag = 'A' AND NOT resolved AND created_at < TIMESTAMP '2001-12-31' - INTERVAL 48 HOUR""",
    "backlogs": """SELECT account_id, count(*) AS critical_backlog, company_name, csm_owner FROM backlog JOIN account USING (account_id)
        GROUP BY account_id, company_name, csm_owner HAVING count(*) > 3""",
    "stream": """SELECT 'product.events' AS topic, 0 AS rank, concat('p', event_id) AS event_id, user_id // 3 AS account_id,
            event_type AS feature, NULL AS severity, 'x' AS status, ts FROM events
        UNION ALL SELECT 'subscription.events', 1, concat('c', account_id), account_id, NULL, NULL,
            CASE WHEN status = 'past_due' THEN 'cancelled' ELSE 'active' END, start_date FROM subscription
        UNION ALL SELECT 'billing.events', 2, concat('b', o_orderkey), o_custkey, NULL, NULL,
            CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                 WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'failed' ELSE 'paid' END, o_orderdate
            FROM orders
        UNION ALL SELECT 'support.events', 3, concat('s', ticket_id), account_id, NULL, severity, status, created_at
            FROM ticket_copy""",
    "hashed": """SELECT *, sha256(concat(event_id, ':', account_id, ':', coalesce(feature, ''), ':',
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'Z')) AS event_hash FROM stream""",
    "once": """SELECT * FROM hashed WHERE status IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_hash ORDER BY severity, status) = 1""",
    # Score change in tenths; an account's events in time order as one list.
    "step": """SELECT account_id, ts, rank, event_id, topic, status,
        CASE WHEN topic = 'product.events' THEN 1 WHEN topic = 'billing.events' AND status = 'failed' THEN -250
             WHEN topic = 'subscription.events' AND status = 'cancelled' THEN -300
             WHEN topic = 'support.events' AND severity = 'high' THEN -150
             WHEN topic = 'support.events' AND severity = 'medium' THEN -50 ELSE 0 END AS d FROM once""",
    "steps": """SELECT account_id, list(d ORDER BY ts, rank, event_id) AS ds, max(ts) AS last_at,
        count(*) FILTER (topic = 'product.events') AS products, bool_or(topic = 'billing.events') AS failed,
        arg_max(topic, (ts, rank, event_id)) = 'subscription.events' AS forced FROM step WHERE d <> 0 GROUP BY account_id""",
    "replayed": """SELECT h.*, s.*  EXCLUDE (account_id), CASE WHEN s.ds IS NULL THEN h.health_score ELSE
        list_reduce(list_prepend(CAST(round(h.health_score * 10) AS INTEGER), s.ds),
            lambda x, y: greatest(0, least(1000, x + y))) / 10 END AS score
        FROM health h LEFT JOIN steps s USING (account_id)""",
}

_ALERT = "alert_id, account_id, alert_type, severity, trigger_reason, status, owner, created_at"
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate"
_LINE_LATEST = """QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1"""
_LOADS = """loaded AS (SELECT invoice_id, account_id, amount, 'open' AS status, due_date FROM invoice
        WHERE due_date < TIMESTAMP '1999-01-01'),
    incoming AS (SELECT invoice_id, account_id, amount + 1 AS amount, status, due_date FROM invoice
        WHERE due_date >= TIMESTAMP '1998-01-01')"""


def _check(name: str, category: str, details: str, count: str) -> str:
    return (f"SELECT '{name}' AS test_name, '{category}' AS category, n = 0 AS passed, n::BIGINT AS failed_count, "
            f"{details} AS details FROM ({count})")


_CHECKS = {
    "dim_account_uniqueness": _check(
        "dim_account_uniqueness", "Uniqueness", "'Ensures no duplicate account_id in dim_account'",
        "SELECT count(*) AS n FROM (SELECT account_id FROM account GROUP BY 1 HAVING count(*) > 1)"),
    "fact_usage_uniqueness": _check(
        "fact_usage_uniqueness", "Uniqueness", "'Ensures no duplicate usage_id in fact_usage'",
        "SELECT count(*) AS n FROM (SELECT usage_id FROM usage GROUP BY 1 HAVING count(*) > 1)"),
    "mrt_customer_health_not_null": _check(
        "mrt_customer_health_not_null", "Completeness",
        "'Ensures critical columns in mrt_customer_health are not null'",
        "SELECT count(*) AS n FROM health WHERE health_score IS NULL OR company_name IS NULL OR mrr IS NULL"),
    "dim_user_account_referential_integrity": _check(
        "dim_user_account_referential_integrity", "Referential Integrity",
        "'Ensures all users belong to valid existing accounts'",
        "SELECT count(*) AS n FROM users u LEFT JOIN account a ON u.account_id = a.account_id "
        "WHERE a.account_id IS NULL"),
    "health_score_and_mrr_range": _check(
        "health_score_and_mrr_range", "Business Rules", "'Health score must be between 0 and 100, MRR >= 0'",
        "SELECT count(*) AS n FROM health WHERE health_score < 0 OR health_score > 100 OR mrr < 0"),
    "telemetry_volume_threshold": _check(
        "telemetry_volume_threshold", "Volume",
        "concat('Fact usage table contains ', c, ' events (target > 1000)')",
        "SELECT count(*) AS c, CASE WHEN count(*) > 1000 THEN 0 ELSE 1 END AS n FROM usage"),
}

QUERIES = {
    "dim_plan": """SELECT plan_name, base_mrr::DOUBLE AS base_mrr, seat_limit, event_quota, count(s.account_id) AS accounts
        FROM plan LEFT JOIN subscription s USING (plan_name) GROUP BY 1, 2, 3, 4""",
    "dim_account": """SELECT account_id, company_name, industry, company_size, region, csm_owner, created_at, cohort
        FROM account""",
    "dim_user": "SELECT user_id, account_id, email, role, created_at FROM users",
    "dim_user_domain": "SELECT user_id, account_id, lower(split_part(email, '@', 2)) AS email_domain FROM users",
    "dim_date": """SELECT strftime(d, '%Y-%m-%d') AS date_key, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
        month(d)::INTEGER AS month, day(d)::INTEGER AS day, (isodow(d) - 1)::INTEGER AS day_of_week,
        isodow(d) >= 6 AS is_weekend FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)""",
    "fact_subscription": """SELECT subscription_id, account_id, plan_name, start_date, status, mrr::DOUBLE AS mrr,
        (mrr * 12)::DOUBLE AS arr FROM subscription""",
    "fact_billing": """SELECT invoice_id, account_id, amount::DOUBLE AS amount, due_date, paid_at, status, is_overdue
        FROM billing""",
    "fact_billing_overdue_days": """SELECT invoice_id, is_overdue, CASE WHEN is_overdue THEN
        greatest(0, date_diff('day', CAST(due_date AS DATE), DATE '1995-07-01')) ELSE 0 END::INTEGER AS days_overdue
        FROM billing""",
    "fact_support": "SELECT * FROM support",
    "fact_usage": """SELECT usage_id, account_id, user_id, feature, event_timestamp,
        strftime(event_date, '%Y-%m-%d') AS event_date FROM usage""",
    "dedup_keep_first": "SELECT * FROM ticket",
    "dedup_keep_latest": f"SELECT {_LINE} FROM lineitem {_LINE_LATEST}",
    "bitemporal_as_of": f"SELECT {_LINE} FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-12-31' {_LINE_LATEST}",
    "ref_integrity_filter": """SELECT invoice_id, account_id, amount::DOUBLE AS amount, due_date, status, paid_at
        FROM billing WHERE account_id IN (SELECT account_id FROM users)""",
    "fk_quarantine": """SELECT invoice_id, account_id, concat('Unknown account_id: ', account_id) AS reason
        FROM billing WHERE account_id NOT IN (SELECT account_id FROM users)""",
    "upsert_insert_ignore": f"""WITH {_LOADS} SELECT * REPLACE (amount::DOUBLE AS amount) FROM
        (SELECT * FROM loaded UNION ALL SELECT * FROM incoming WHERE invoice_id NOT IN (SELECT invoice_id FROM loaded))""",
    "upsert_replace": f"""WITH {_LOADS} SELECT * REPLACE (amount::DOUBLE AS amount) FROM
        (SELECT * FROM incoming UNION ALL SELECT * FROM loaded WHERE invoice_id NOT IN (SELECT invoice_id FROM incoming))""",
    "upsert_update_columns": f"""WITH {_LOADS} SELECT * REPLACE (amount::DOUBLE AS amount) FROM
        (SELECT l.* REPLACE (CASE WHEN i.invoice_id IS NULL THEN l.status ELSE i.status END AS status)
            FROM loaded l LEFT JOIN incoming i USING (invoice_id)
        UNION ALL SELECT * FROM incoming WHERE invoice_id NOT IN (SELECT invoice_id FROM loaded))""",
    "incremental_load": """SELECT usage_id, account_id, feature, event_timestamp FROM usage WHERE event_timestamp >
        (SELECT max(event_timestamp) FROM usage WHERE event_timestamp < TIMESTAMP '2024-01-20')""",
    "normalise_nulls": """SELECT CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS linestatus, count(*) AS rows,
        count(*) FILTER (l_discount <> 0) AS with_discount,
        sum(l_discount::DECIMAL(10,2)) FILTER (l_discount <> 0)::DOUBLE AS sum_discount FROM lineitem GROUP BY 1""",
    "parameterised_lookup": """SELECT invoice_id, account_id, amount::DOUBLE AS amount FROM billing
        WHERE status = 'failed' AND amount >= 250000""",
    "usage_30d_by_account": "SELECT * FROM usage30",
    "support_by_account": "SELECT * REPLACE (sla_compliance_rate::DOUBLE AS sla_compliance_rate) FROM support_acc",
    "billing_by_account": "SELECT * FROM billing_acc",
    "mrt_customer_health": "SELECT * FROM health",
    "mrt_revenue_summary": "SELECT * FROM revenue",
    "latest_revenue": "SELECT * FROM revenue",
    "usage_totals": "SELECT count(*) AS total_events, count(DISTINCT user_id) AS active_users FROM usage",
    "top_features": """SELECT feature, count(*) AS event_count FROM usage GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "feature_share_of_max": """SELECT feature, count(*) AS event_count,
        round(count(*) * 100.0 / max(count(*)) OVER ())::INTEGER AS share_of_max FROM usage GROUP BY 1""",
    "daily_usage_trend": """SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS daily_events FROM usage
        GROUP BY usage.event_date ORDER BY usage.event_date DESC LIMIT 30""",
    "daily_usage_by_account": """SELECT account_id, strftime(event_date, '%Y-%m-%d') AS event_date,
        count(*) AS daily_events FROM usage GROUP BY account_id, usage.event_date""",
    "usage_tumbling": """SELECT feature, date_trunc('hour', event_timestamp) AS window_start,
        date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end, count(*) AS event_count
        FROM usage GROUP BY 1, 2, 3""",
    "usage_sliding": """SELECT feature, w AS window_start, w + INTERVAL 1 DAY AS window_end, count(*) AS event_count
        FROM (SELECT feature, unnest(generate_series(date_trunc('hour', event_timestamp) - INTERVAL 23 HOUR,
            date_trunc('hour', event_timestamp), INTERVAL 1 HOUR)) AS w FROM usage) GROUP BY 1, 2""",
    "usage_session": """SELECT user_id, session_no::BIGINT AS session_no, min(event_timestamp) AS session_start,
        max(event_timestamp) AS session_end, count(*) AS event_count
        FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_timestamp, usage_id ROWS UNBOUNDED PRECEDING) AS session_no
            FROM (SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER (PARTITION BY user_id
                ORDER BY event_timestamp, usage_id) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS starts FROM usage))
        GROUP BY 1, 2""",
    "dau_mau": """SELECT strftime(d, '%Y-%m-%d') AS event_date, dau, mau, round(dau / mau, 4) AS stickiness FROM
        (SELECT event_date AS d, count(DISTINCT user_id) AS dau, (SELECT count(DISTINCT user_id) FROM user_day x
            WHERE x.event_date BETWEEN user_day.event_date - 29 AND user_day.event_date) AS mau
         FROM user_day GROUP BY event_date)""",
    "feature_adoption": """WITH r AS (SELECT * FROM usage WHERE event_timestamp >= TIMESTAMP '2024-01-01')
        SELECT feature, count(DISTINCT account_id) AS adopting_accounts,
        (SELECT count(DISTINCT account_id) FROM r) AS active_accounts,
        round(count(DISTINCT account_id) / (SELECT count(DISTINCT account_id) FROM r) * 100.0, 2) AS adoption_pct
        FROM r GROUP BY 1""",
    "feature_adoption_weekly": """WITH r AS (SELECT *, CAST(date_trunc('week', event_timestamp) AS DATE) AS w FROM usage)
        SELECT strftime(w, '%Y-%m-%d') AS week_start, feature, count(DISTINCT account_id) AS adopting_accounts,
        any_value(a) AS active_accounts, count(*) AS event_count,
        round(count(DISTINCT account_id) / any_value(a) * 100.0, 2) AS adoption_pct
        FROM r JOIN (SELECT w, count(DISTINCT account_id) AS a FROM r GROUP BY 1) USING (w) GROUP BY w, feature""",
    "sla_breach_rate": """SELECT severity, count(*) AS tickets, count(*) FILTER (sla_breached) AS breached,
        round(count(*) FILTER (sla_breached) / count(*) * 100.0, 2) AS breach_rate_pct FROM support GROUP BY 1""",
    "health_daily": "SELECT * FROM health_daily_usage",
    "rule_health_drop_wow": "SELECT * FROM health_drop",
    "health_drop_alerts": """SELECT concat('alt_drop_', account_id, '_', date_key) AS alert_id, account_id, 'CSM Alert' AS alert_type, 'high' AS severity,
        concat('Account health score fell by ', drop_pct::VARCHAR, '% within a week to ', health_score::VARCHAR, '.') AS trigger_reason,
        'open' AS status, csm_owner AS owner, TIMESTAMP '2001-12-31' AS created_at FROM health_drop JOIN account USING (account_id)""",
    "standing_history": """SELECT account_id, payment_status, status AS subscription_status, strftime(valid_from, '%Y-%m-%d') AS valid_from,
        strftime(valid_to, '%Y-%m-%d') AS valid_to FROM standing""",
    "health_daily_as_of": """SELECT date_key, payment_status, count(*) AS accounts, sum(health_score::DECIMAL(10,1))::DOUBLE AS score_sum,
        sum(open_tickets_count)::BIGINT AS open_tickets FROM health_daily_known GROUP BY 1, 2""",
    "account_health_lookup": "SELECT * FROM health WHERE account_id = 7",
    "customer_search": """SELECT account_id, company_name, csm_owner, health_tier FROM health WHERE health_tier = 'At Risk'
        AND (contains(lower(company_name), 'r#00000004') OR contains(account_id::VARCHAR, 'r#00000004')
            OR contains(lower(csm_owner), 'r#00000004'))""",
    "churn_risk_accounts": """SELECT account_id, company_name, industry, plan, mrr, csm_owner, health_score, health_tier,
        churn_risk_score, open_tickets, critical_tickets, payment_status FROM health""",
    "churn_risk_bands": """SELECT count(*) FILTER (churn_risk_score >= 0.6) AS high_risk_count,
        count(*) FILTER (churn_risk_score >= 0.3 AND churn_risk_score < 0.6) AS moderate_risk_count,
        count(*) FILTER (churn_risk_score < 0.3) AS low_risk_count, count(*) AS total_evaluated FROM health""",
    "high_risk_accounts": """SELECT account_id, company_name, mrr, health_score, churn_risk_score, open_tickets,
        payment_status FROM health WHERE churn_risk_score >= 0.5""",
    "top_risk_accounts": """SELECT account_id, company_name, mrr, health_score, churn_risk_score, csm_owner FROM health
        WHERE health_tier = 'Critical' ORDER BY churn_risk_score DESC, account_id LIMIT 5""",
    "health_distribution": "SELECT health_tier, count(*) AS accounts FROM health GROUP BY 1",
    "recent_events": """SELECT usage_id AS event_id, account_id, user_id, feature, event_timestamp FROM usage
        ORDER BY event_timestamp DESC, usage_id LIMIT 25""",
    "recent_open_alerts": """SELECT alert_id, account_id, alert_type, severity, trigger_reason, status, created_at FROM alert
        ORDER BY created_at DESC, alert_id LIMIT 5""",
    "alerts_by_status": f"SELECT {_ALERT} FROM acked WHERE status = 'acknowledged'",
    "expansion_scores": """SELECT account_id, company_name, plan AS current_plan, mrr AS current_mrr,
        round(seat * 100, 1) AS seat_utilization, round(evt * 100, 1) AS event_utilization, health_score,
        score AS expansion_score,
        CASE WHEN score >= 0.75 THEN 'High' WHEN score >= 0.45 THEN 'Moderate' ELSE 'Low' END AS opportunity_tier,
        CASE plan WHEN 'Starter' THEN 'Professional' WHEN 'Professional' THEN 'Enterprise'
             WHEN 'Enterprise' THEN 'Enterprise Plus' ELSE 'Custom Dedicated Cluster' END AS recommended_plan,
        round(mrr * 0.8::DOUBLE, 2) AS potential_mrr_expansion
        FROM (SELECT *, round(least(0.99, greatest(0.01, seat * 0.40::DOUBLE + evt * 0.35::DOUBLE
                + health_score / 100.0 * 0.25::DOUBLE))::DOUBLE, 3) AS score
            FROM (SELECT h.*, least(1.0::DOUBLE, active_users_30d / seat_limit) AS seat,
                least(1.0::DOUBLE, events_last_30d * 10 / event_quota) AS evt
                FROM health h JOIN plan ON h.plan = plan_name))""",
    "usage_anomalies": """SELECT account_id, strftime(d, '%Y-%m-%d') AS event_date, n AS latest_daily_events,
        round(mean, 2) AS historical_mean, round(std, 2) AS historical_std, round(z, 2) AS z_score,
        round(wow * 100, 2) AS wow_change_pct, kind AS anomaly_type,
        CASE WHEN kind = 'Severe Usage Drop' THEN CASE WHEN z < -3 THEN 'high' ELSE 'medium' END
             WHEN kind = 'Usage Spike' THEN CASE WHEN z > 3 THEN 'high' ELSE 'medium' END END AS severity,
        CASE kind WHEN 'Severe Usage Drop' THEN 'Trigger CSM check-in on possible product blockage'
             WHEN 'Usage Spike' THEN 'Review increased product adoption for expansion opportunity' END AS suggested_action
        FROM (SELECT *, CASE WHEN z < -2.5 OR coalesce(wow <= -0.65, false) THEN 'Severe Usage Drop'
                WHEN z > 2.5 THEN 'Usage Spike' END AS kind
            FROM (SELECT *, CASE WHEN std > 0 THEN (n - mean) / std WHEN mean <> 0 THEN (n - mean) / mean ELSE 0 END AS z,
                    CASE WHEN p7 > 0 THEN (l7 - p7) / p7 END AS wow
                FROM (SELECT account_id, event_date AS d, n, row_number() OVER (PARTITION BY account_id ORDER BY event_date DESC) AS rn,
                        avg(n) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS mean,
                        stddev_pop(n) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS std,
                        count(*) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS history,
                        sum(n) OVER (w ROWS 6 PRECEDING)::DOUBLE AS l7,
                        sum(n) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING)::DOUBLE AS p7
                    FROM (SELECT account_id, event_date, count(*) AS n FROM usage GROUP BY 1, 2)
                    WINDOW w AS (PARTITION BY account_id ORDER BY event_date))
                WHERE rn = 1 AND history = 14))""",
    "forecast_scenarios": """SELECT scenario, label, starting_mrr, starting_arr, round(annual_growth, 6) AS annual_growth,
        round(monthly_growth, 8) AS monthly_growth FROM scenario""",
    "revenue_forecast": """SELECT period, month_index, max(mrr) FILTER (scenario = 'base') AS mrr_base,
        max(arr) FILTER (scenario = 'base') AS arr_base, max(mrr) FILTER (scenario = 'bull') AS mrr_bull,
        max(arr) FILTER (scenario = 'bull') AS arr_bull, max(mrr) FILTER (scenario = 'bear') AS mrr_bear,
        max(arr) FILTER (scenario = 'bear') AS arr_bear FROM projection GROUP BY 1, 2""",
    "forecast_at_month": "SELECT scenario, month_index, period, mrr, arr FROM projection WHERE month_index = 12",
    "forecast_from_movements": """SELECT scenario, 12 AS month_index, 'Month +12' AS period, round(mrr, 2) AS mrr,
        round(mrr * 12, 2) AS arr FROM (SELECT scenario, total * pow(1 + (pow(1 + growth + shift, 1.0::DOUBLE / 12) - 1), 12) AS mrr
            FROM (SELECT sum(ending_mrr)::DOUBLE AS total,
                (round(sum(expansion_mrr)::DOUBLE / sum(beginning_mrr)::DOUBLE * 100, 2)
                    - round(sum(churn_mrr)::DOUBLE / sum(beginning_mrr)::DOUBLE * 100, 2)) / 100 AS growth
                FROM movement WHERE period = 2000),
            (VALUES ('base', 0.0::DOUBLE), ('bull', 0.02::DOUBLE), ('bear', -0.02::DOUBLE)) v(scenario, shift))""",
    "churn_features": """SELECT account_id, events_last_30d, active_users_30d, open_tickets, critical_tickets,
        sla_compliance_rate, mrr, CASE WHEN payment_status <> 'Good Standing' THEN 1 ELSE 0 END AS is_payment_failed,
        CASE WHEN health_tier = 'Critical' THEN 1 ELSE 0 END AS churn_label FROM health""",
    "churn_risk_tiers": """SELECT account_id, churn_risk_score AS churn_probability,
        CASE WHEN churn_risk_score >= 0.7 THEN 'High' WHEN churn_risk_score >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk_tier,
        CASE WHEN churn_risk_score >= 0.7 THEN 'Schedule Executive Retention Review'
             WHEN churn_risk_score >= 0.4 THEN 'Schedule Customer Success Check-in'
             ELSE 'Continue Monitoring' END AS recommended_action FROM health""",
    "classification_metrics": """SELECT *, round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy,
        coalesce(round(tp / nullif(tp + fp, 0), 4), 0) AS precision, coalesce(round(tp / nullif(tp + fn, 0), 4), 0) AS recall,
        coalesce(round(2 * tp / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1_score FROM matrix""",
    "cost_confusion": """SELECT *, fn * 50000.0::DOUBLE AS missed_cost, fp * 25.0::DOUBLE AS false_alarm_cost,
        fn * 50000.0::DOUBLE + fp * 25.0::DOUBLE AS total_cost FROM
        (SELECT count(*) FILTER (score >= 0.6 AND label = 1) AS tp, count(*) FILTER (score >= 0.6 AND label = 0) AS fp,
            count(*) FILTER (score < 0.6 AND label = 1) AS fn, count(*) FILTER (score < 0.6 AND label = 0) AS tn FROM labelled)""",
    "roc_auc": """SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
        round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
            / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 4) AS roc_auc
        FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM labelled)""",
    "pr_auc": """SELECT sum(pos)::BIGINT AS positives, round(sum(pos * found / shown) / sum(pos), 4) AS pr_auc
        FROM (SELECT pos, sum(pos) OVER w::DOUBLE AS found, sum(n) OVER w::DOUBLE AS shown
            FROM (SELECT score, sum(label) AS pos, count(*) AS n FROM labelled GROUP BY score)
            WINDOW w AS (ORDER BY score DESC))""",
    "recall_top_decile": """SELECT count(*) FILTER (p <= 0.1) AS top_rows,
        sum(label) FILTER (p <= 0.1)::BIGINT AS top_positives, sum(label)::BIGINT AS positives,
        round(sum(label) FILTER (p <= 0.1) / sum(label), 4) AS recall
        FROM (SELECT label, percent_rank() OVER (ORDER BY score DESC) AS p FROM labelled)""",
    "out_of_time_split": """SELECT CASE WHEN event_timestamp < TIMESTAMP '2024-01-22' THEN 'train' ELSE 'test' END AS split,
        feature, count(*) AS rows FROM usage GROUP BY 1, 2""",
    "drift_psi": """WITH b AS (SELECT event_type, (value >= 2)::INT + (value >= 5)::INT + (value >= 10)::INT
            + (value >= 15)::INT + (value >= 20)::INT + (value >= 30)::INT + (value >= 50)::INT + (value >= 80)::INT AS bin,
            ts >= TIMESTAMP '2024-01-16' AS now FROM events WHERE value IS NOT NULL),
        c AS (SELECT event_type, bin, count(*) FILTER (NOT now) AS nb, count(*) FILTER (now) AS nc FROM b GROUP BY 1, 2),
        s AS (SELECT *, greatest(nb / sum(nb) OVER (PARTITION BY event_type), 1e-4) AS p,
            greatest(nc / sum(nc) OVER (PARTITION BY event_type), 1e-4) AS q FROM c)
        SELECT event_type, sum(nb)::BIGINT AS base_rows, sum(nc)::BIGINT AS current_rows,
            round(sum((q - p) * ln(q / p)), 4) AS psi FROM s GROUP BY 1""",
    "rule_health_drop": f"SELECT {_ALERT} FROM fired_health",
    "rule_payment_failure": f"SELECT {_ALERT}, detail FROM fired_billing",
    "rule_upsell": f"SELECT {_ALERT} FROM fired_upsell",
    "rule_support": f"SELECT {_ALERT} FROM fired_support",
    "rule_critical_backlog": "SELECT * FROM backlogs",
    "backlog_alerts": """SELECT concat('alt_backlog_', account_id) AS alert_id, account_id, 'Support Deterioration' AS alert_type, 'critical' AS severity,
        concat('Account has ', critical_backlog, ' critical tickets unresolved for over 48 hours.') AS trigger_reason, 'open' AS status,
        csm_owner AS owner, TIMESTAMP '2001-12-31' AS created_at FROM backlogs""",
    "all_alerts": f"SELECT {_ALERT} FROM alert",
    "alerts_acknowledge": """SELECT alert_id, status, acknowledged_at, CASE WHEN hit THEN 3 ELSE 1 END AS entries,
        CASE WHEN hit THEN '- > Account team > Finance' ELSE '-' END AS actors,
        CASE WHEN hit THEN 'ACKNOWLEDGED' ELSE 'TRIGGERED' END AS last_action,
        CASE WHEN hit THEN 'Finance' END AS last_by, notes AS last_notes FROM acked""",
    "alerts_acknowledge_errors": """SELECT alert_id, 'Alert not found' AS error FROM request, (VALUES (1), (2)) v(n)
        WHERE alert_id NOT IN (SELECT alert_id FROM alert)""",
    "alerts_upsert": """WITH fired AS (SELECT concat('alt_health_', account_id) AS alert_id, 'critical' AS severity,
            concat('Account health score deteriorated to ', health_score, ' (Critical tier).') AS trigger_reason
            FROM health WHERE health_score < 60
            UNION ALL SELECT alert_id, severity, trigger_reason FROM fired_billing)
        SELECT alert_id, severity, trigger_reason, status, created_at, acknowledged_at FROM acked
        UNION ALL SELECT alert_id, severity, trigger_reason, 'open', TIMESTAMP '2024-02-02', NULL FROM fired
        WHERE alert_id NOT IN (SELECT alert_id FROM acked)""",
    "notification_outbox": """WITH route AS (SELECT * FROM (VALUES
            ('CSM Alert', 'slack', '#csm-urgent-retention', 'Health Alert: '),
            ('Payment Failure', 'slack', '#billing-dunning-ops', 'Billing Failure: '),
            ('Upsell Recommendation', 'teams', 'expansion-desk', 'Upsell Opportunity: '),
            ('Support Deterioration', 'slack', '#support-escalations', 'Support Deterioration: '))
            t(alert_type, chat, channel, prefix)),
        mail AS (SELECT * FROM (VALUES ('CSM Alert', 'csm@example.com', 'DISABLED'), ('CSM Alert', 'manager@example.com', 'DISABLED'),
            ('Payment Failure', 'billing@example.com', 'DISABLED'), ('Upsell Recommendation', NULL, 'SKIPPED'),
            ('Support Deterioration', NULL, 'SKIPPED')) t(alert_type, address, mail_status))
        SELECT alert_id, alert_type, severity, chat AS kind, channel AS target,
            CASE WHEN chat = 'slack' THEN concat('[', upper(severity), '] ') ELSE '' END || prefix || company_name AS title,
            CASE WHEN chat = 'slack' THEN CASE severity WHEN 'critical' THEN '#e01e5a' WHEN 'high' THEN '#ecb22e'
                ELSE '#2eb886' END END AS colour, trigger_reason AS message, 'DISPATCHED' AS status
        FROM alert JOIN route USING (alert_type)
        UNION ALL SELECT alert_id, alert_type, severity, 'email', address, prefix || company_name, NULL, trigger_reason, mail_status
        FROM alert JOIN route USING (alert_type) JOIN mail USING (alert_type)""",
    "dq_uniqueness": " UNION ALL ".join([
        _CHECKS["dim_account_uniqueness"], _CHECKS["fact_usage_uniqueness"],
        _check("ticket_copies_uniqueness", "Uniqueness", "'Delivered tickets'",
               "SELECT count(*) AS n FROM (SELECT ticket_id FROM ticket_copy GROUP BY 1 HAVING count(*) > 1)")]),
    "dq_not_null": " UNION ALL ".join([
        _CHECKS["mrt_customer_health_not_null"],
        _check("billing_not_null", "Completeness", "'Paid invoices'",
               "SELECT count(*) AS n FROM billing WHERE paid_at IS NULL OR amount IS NULL")]),
    "dq_referential_integrity": " UNION ALL ".join([
        _CHECKS["dim_user_account_referential_integrity"],
        _check("billing_user_integrity", "Referential Integrity", "'Invoiced accounts have users'",
               "SELECT count(*) AS n FROM billing WHERE account_id NOT IN (SELECT account_id FROM users)")]),
    "dq_range": " UNION ALL ".join([
        _CHECKS["health_score_and_mrr_range"],
        _check("billing_range", "Business Rules", "'Invoices up to 400,000'",
               "SELECT count(*) AS n FROM billing WHERE amount > 400000")]),
    "dq_volume": _CHECKS["telemetry_volume_threshold"],
    "dq_checks": " UNION ALL ".join(_CHECKS.values()),
    "dq_report": f"""SELECT CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'WARNING' END AS status, count(*) AS total_checks,
        count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks,
        TIMESTAMP '2024-01-31' AS executed_at FROM ({' UNION ALL '.join(_CHECKS.values())})""",
    "dq_freshness": """SELECT max(event_timestamp) AS newest,
        round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(event_timestamp))) / 6e7, 2) AS minutes_since_newest FROM usage""",
    "dq_accepted_values": """SELECT 'subscription_status' AS test_name, n = 0 AS passed, n AS failed_count FROM
            (SELECT count(*) AS n FROM subscription WHERE status NOT IN ('active', 'past_due', 'cancelled', 'trial'))
        UNION ALL SELECT 'invoice_status', n = 0, n FROM
            (SELECT count(*) AS n FROM billing WHERE status NOT IN ('paid', 'open', 'failed', 'void'))
        UNION ALL SELECT 'ticket_severity', n = 0, n FROM
            (SELECT count(*) AS n FROM support WHERE severity NOT IN ('low', 'medium', 'high'))""",
    "dq_null_pct": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows, count(*) AS total_rows, "
        f"round((count(*) - count({c})) / count(*) * 100.0, 2) AS null_pct FROM support"
        for c in ("ticket_id", "severity", "resolved_at", "resolution_time_hours")),
    "dq_row_variance": """SELECT *, round((rows - previous_rows) / previous_rows * 100.0, 2) AS change_pct FROM
        (SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS rows,
            lag(count(*)) OVER (ORDER BY usage.event_date) AS previous_rows FROM usage GROUP BY usage.event_date)""",
    "mrr_movements": """SELECT account_id, period, beginning_mrr::DOUBLE AS beginning_mrr, new_mrr::DOUBLE AS new_mrr,
        expansion_mrr::DOUBLE AS expansion_mrr, contraction_mrr::DOUBLE AS contraction_mrr, churn_mrr::DOUBLE AS churn_mrr,
        ending_mrr::DOUBLE AS ending_mrr, net_new_mrr::DOUBLE AS net_new_mrr, change_type FROM movement""",
    "net_dollar_retention": """SELECT period, sum(beginning_mrr)::DOUBLE AS beginning_mrr, sum(expansion_mrr)::DOUBLE AS expansion_mrr,
        sum(contraction_mrr)::DOUBLE AS contraction_mrr, sum(churn_mrr)::DOUBLE AS churn_mrr,
        round((sum(beginning_mrr) + sum(expansion_mrr) - sum(contraction_mrr) - sum(churn_mrr))::DOUBLE
            / sum(beginning_mrr)::DOUBLE * 100.0, 2) AS ndr_pct
        FROM movement WHERE change_type <> 'opening' GROUP BY 1""",
    "net_revenue_churn": """SELECT period, sum(beginning_mrr)::DOUBLE AS beginning_mrr, sum(expansion_mrr)::DOUBLE AS expansion_mrr,
        sum(churn_mrr)::DOUBLE AS churn_mrr,
        round((sum(churn_mrr) - sum(expansion_mrr))::DOUBLE / sum(beginning_mrr)::DOUBLE * 100.0, 2) AS net_revenue_churn_pct
        FROM movement WHERE change_type <> 'opening' GROUP BY 1""",
    "logo_retention": """SELECT *, round((ending_accounts - new_accounts) / starting_accounts * 100.0, 2) AS logo_retention_pct,
        round(churned_accounts / starting_accounts * 100.0, 2) AS logo_churn_pct FROM
        (SELECT period, count(*) FILTER (beginning_mrr > 0) AS starting_accounts,
            count(*) FILTER (ending_mrr > 0) AS ending_accounts, count(*) FILTER (change_type = 'new') AS new_accounts,
            count(*) FILTER (change_type = 'churn') AS churned_accounts
            FROM movement WHERE change_type <> 'opening' GROUP BY 1)""",
    "cohort_retention": """SELECT f AS cohort_period, CAST(m - f AS INTEGER) AS age, count(*) AS active_accounts,
        first(size) AS cohort_size, round(count(*) / first(size) * 100.0, 2) AS retention_pct
        FROM month_paid JOIN (SELECT account_id, min(m) AS f FROM month_paid GROUP BY 1) USING (account_id)
        JOIN (SELECT f, count(*) AS size FROM (SELECT min(m) AS f FROM month_paid GROUP BY account_id) GROUP BY 1) USING (f)
        GROUP BY f, m""",
    "churn_yoy": """SELECT a.*, b.churn_pct AS churn_pct_year_ago, round(a.churn_pct - b.churn_pct, 2) AS yoy_change
        FROM month_churn a LEFT JOIN month_churn b ON b.month_number = a.month_number - 12""",
    "trend_residual": """SELECT feature, strftime(d, '%Y-%m-%d') AS event_date, n AS daily_events, round(t, 4) AS trend,
        round(n - t, 4) AS residual FROM (SELECT feature, event_date AS d, n, avg(n) OVER (PARTITION BY feature
            ORDER BY event_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS t
            FROM (SELECT feature, event_date, count(*) AS n FROM usage GROUP BY 1, 2))""",
    "linear_trend": """SELECT (m % 12) // 3 AS quarter_of_year, count(*) AS points, round(regr_slope(y, m), 2) AS slope,
        round(regr_intercept(y, m), 2) AS intercept FROM (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS m,
            sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS y FROM orders GROUP BY 1) GROUP BY 1""",
    "exp_smoothing": """SELECT account_id, count(*) AS points,
        round(list_reduce(list(paid::DOUBLE ORDER BY period), lambda x, y: x * 0.7::DOUBLE + y * 0.3::DOUBLE), 8) AS smoothed
        FROM yearly GROUP BY 1""",
    "event_hash_dedup": """SELECT event_id, account_id, event_hash AS _event_hash, severity, status FROM hashed
        WHERE topic = 'support.events'
        QUALIFY row_number() OVER (PARTITION BY event_hash ORDER BY severity, status) = 1""",
    "stream_metrics": """SELECT topic, sum(copies)::BIGINT AS received, count(*) AS published,
        sum(copies - 1)::BIGINT AS duplicates_dropped, count(*) FILTER (bad) AS dead_lettered,
        count(*) FILTER (NOT bad) AS consumed
        FROM (SELECT topic, event_hash, count(*) AS copies, bool_or(status IS NULL) AS bad FROM hashed GROUP BY 1, 2)
        GROUP BY 1""",
    "stream_dead_letters": """SELECT topic AS _topic, event_id, account_id, 3 AS _retry_count,
        'Billing event missing required field: status' AS _fatal_error FROM hashed WHERE status IS NULL""",
    "health_replay": """SELECT account_id, score AS health_score,
        CASE WHEN ds IS NULL THEN health_tier WHEN forced THEN 'Critical' WHEN score >= 75 THEN 'Healthy'
             WHEN score >= 50 THEN 'At Risk' ELSE 'Critical' END AS health_tier,
        (events_last_30d + coalesce(products, 0))::BIGINT AS events_last_30d,
        CASE WHEN failed THEN 'Failed / Overdue' ELSE payment_status END AS payment_status,
        coalesce(last_at, last_updated_at) AS last_updated_at FROM replayed""",
}

QUERIES |= {
    "scan_bronze": """SELECT account_id::VARCHAR AS account_id, company_name, industry, company_size AS size, region,
        csm_owner AS owner, created_at, cohort FROM account""",
    "scan_bronze_quarantine": """SELECT invoice_id::VARCHAR AS invoice_id, account_id::VARCHAR AS account_id, status,
        CASE WHEN status <> 'failed' THEN amount::DOUBLE END AS amount,
        CASE WHEN status = 'failed' THEN 'malformed record' END AS reason FROM invoice""",
    "bronze_audit_columns": """SELECT c_custkey, TIMESTAMP '2024-01-31' AS _ingested_at, 'crm' AS _source_channel,
        sha256(concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","c_nationkey":', c_nationkey,
            ',"c_mktsegment":"', c_mktsegment, '"}')) AS _raw_payload_hash FROM customer""",
    "sink_overwrite": QUERIES["fact_subscription"] + " WHERE status = 'active'",
    "sink_csv": """SELECT invoice_id::VARCHAR AS invoice_id, account_id::VARCHAR AS account_id, amount::DOUBLE AS amount,
        due_date, paid_at, status, is_overdue FROM billing""",
    "write_partitioned": """SELECT account_id, strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS daily_events
        FROM usage WHERE usage.event_date >= DATE '2024-01-20' GROUP BY account_id, usage.event_date""",
    "publish_snapshot": QUERIES["fact_billing"],
    "sink_audit_append": """SELECT run_id, layer, 'SUCCESS' AS status, n AS records_processed, 90000::BIGINT AS duration_ms, NULL::VARCHAR AS error_message
        FROM (SELECT 'run0' AS run_id, 'bronze' AS layer, count(*) AS n FROM orders UNION ALL SELECT 'run1', 'silver', count(*) FROM customer
            UNION ALL SELECT 'run2', 'gold', count(*) FROM events)""",
    "create_tables": """SELECT subscription_id::VARCHAR AS subscription_id, account_id::VARCHAR AS account_id, plan_name, start_date, status,
        mrr::DOUBLE AS mrr, (mrr * 12)::DOUBLE AS arr FROM subscription""",
    "alert_history_json": """SELECT alert_id, CASE WHEN spoilt THEN 0 ELSE 1 END::INTEGER AS entries, CASE WHEN NOT spoilt THEN 'TRIGGERED' END AS action,
        CASE WHEN NOT spoilt THEN created_at END AS at
        FROM (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(alert_id, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 3 = 0 AS spoilt FROM alert)""",
    "health_replay_drain_order": """SELECT h.account_id, CASE WHEN ds IS NULL THEN h.health_score ELSE
            list_reduce(list_prepend(CAST(round(h.health_score * 10) AS INTEGER), ds), lambda x, y: greatest(0, least(1000, x + y))) / 10 END AS health_score,
        (events_last_30d + coalesce(products, 0))::BIGINT AS events_last_30d,
        CASE WHEN failed THEN 'Failed / Overdue' ELSE payment_status END AS payment_status
        FROM health h LEFT JOIN (SELECT account_id, list(d ORDER BY rank, ts, event_id) AS ds, count(*) FILTER (topic = 'product.events') AS products,
            bool_or(topic = 'billing.events') AS failed FROM step WHERE d <> 0 GROUP BY account_id) USING (account_id)""",
    "stream_unknown_topic": """SELECT CASE WHEN topic = 'support.events' THEN 'tickets' ELSE topic END AS _topic,
        CASE WHEN topic = 'support.events' THEN 'Unknown topic: tickets' WHEN status IS NULL THEN 'Billing event missing required field: status' END AS _error,
        count(*) AS events FROM stream GROUP BY 1, 2""",
    "dq_error_isolation": f"""SELECT test_name, passed AND test_name NOT IN ('fact_usage_uniqueness', 'telemetry_volume_threshold') AS passed,
        CASE WHEN test_name NOT IN ('fact_usage_uniqueness', 'telemetry_volume_threshold') THEN failed_count END AS failed_count,
        test_name IN ('fact_usage_uniqueness', 'telemetry_volume_threshold') AS has_error FROM ({' UNION ALL '.join(_CHECKS.values())})
        WHERE test_name IN ('dim_account_uniqueness', 'dim_user_account_referential_integrity', 'fact_usage_uniqueness',
            'telemetry_volume_threshold', 'mrt_customer_health_not_null', 'health_score_and_mrr_range')""",
    "stream_envelope": """SELECT event_id, account_id, TIMESTAMP '2024-01-31' AS _published_at, 0 AS _retry_count,
        3 AS _max_retries, event_hash AS _event_hash FROM hashed WHERE topic = 'product.events'""",
    "stream_validate": """SELECT topic AS _topic, CASE WHEN status IS NULL THEN
        'Billing event missing required field: status' END AS _error, count(*) AS events FROM stream GROUP BY 1, 2""",
    "stream_dedup": "SELECT DISTINCT topic AS _topic, event_id, account_id FROM stream",
    "stream_fk_quarantine": """SELECT event_id, account_id, concat('Unknown account_id: ', account_id) AS _error FROM stream
        WHERE topic = 'billing.events' AND status IS NOT NULL AND account_id NOT IN (SELECT account_id FROM users)""",
    "dlq_redrive": """SELECT event_id, CASE WHEN s.status = 'active' THEN 'republished' ELSE 'kept' END AS outcome,
        CASE WHEN s.status = 'active' THEN 0 ELSE 1 END AS attempts FROM stream e JOIN subscription s USING (account_id)
        WHERE topic = 'billing.events' AND e.status IS NOT NULL AND account_id NOT IN (SELECT account_id FROM users)""",
    "stream_health": QUERIES["health_replay"],
    "stream_dlq": QUERIES["stream_dead_letters"],
    "stream_job_metrics": QUERIES["stream_metrics"],
    "stream_insert_ignore": """SELECT concat('p', usage_id) AS usage_id, account_id, user_id::VARCHAR AS user_id, feature,
        event_timestamp, strftime(event_date, '%Y-%m-%d') AS event_date FROM usage""",
    "stream_dim_date": """SELECT strftime(d, '%Y-%m-%d') AS date_key, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
        month(d)::INTEGER AS month, day(d)::INTEGER AS day, (isodow(d) - 1)::INTEGER AS day_of_week,
        isodow(d) >= 6 AS is_weekend FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM once)""",
    "stream_malformed": """SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Billing event missing required field: status'
            ELSE 'Malformed record' END AS reason,
        CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_orderkey AS VARCHAR)
             ELSE concat('{"event_id":"b', o_orderkey, '","account_id":"', o_custkey, '","invoice_id":"', o_orderkey, '","amount":',
                CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR), ',"status":"paid","timestamp":"',
                CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'noon"}' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"' END) END AS record
        FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
    "stream_malformed_metrics": """SELECT 'billing.events' AS topic, count(*) + count(*) FILTER (o_orderkey % 10 = 0) AS received,
        count(*) AS published, count(*) FILTER (o_orderkey % 10 = 0) AS duplicates_dropped,
        count(*) FILTER (o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS dead_lettered,
        count(*) FILTER (o_orderpriority NOT IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS consumed FROM orders""",
    "stream_windowed_usage": f"SELECT *, true AS users_close FROM ({QUERIES['usage_tumbling']})",
    "stream_sessions": f"""SELECT user_id, session_start AS window_start, session_end + INTERVAL 1 HOUR AS window_end, event_count
        FROM ({QUERIES['usage_session']})""",
    "stream_state_health": QUERIES["health_replay"],
    "stream_late_events": QUERIES["usage_tumbling"],
    "daily_incremental": "SELECT account_id, plan, events_last_30d, active_users_30d, open_tickets, critical_tickets FROM health",
    "usage_sketches": "SELECT feature, count(*) AS events, true AS close FROM usage GROUP BY 1",
    "dau_mau_sketches": "SELECT DISTINCT strftime(event_date, '%Y-%m-%d') AS event_date, true AS dau_close, true AS mau_close FROM usage",
}


def _needed(sql: str) -> list[str]:
    """CTEs the text uses, directly or through others, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            pending.append(CTES[name])
    return [name for name in CTES if name in found]


def statements() -> dict[str, str]:
    out = {}
    for name, sql in QUERIES.items():
        parts = ", ".join(f"{cte} AS ({CTES[cte]})" for cte in _needed(sql))
        if not parts:
            out[name] = sql
        elif sql.startswith("WITH "):
            out[name] = f"WITH {parts}, {sql[5:]}"
        else:
            out[name] = f"WITH {parts} {sql}"
    return out
