"""The scorecard input on hand-made tables: next to its SQL, and what it reads."""

import duckdb

import __spark_entry__ as entry
import check
from panelkit.plans import views


def tables(folder):
    """Forty orders of nine clients with up to five lines each, and events of the first users."""
    con = duckdb.connect()
    made = {
        "orders": """SELECT i::BIGINT AS o_orderkey, (i * 7 % 9)::BIGINT AS o_custkey, ['F', 'O', 'P'][1 + i % 3] AS o_orderstatus,
            100.25 * (i % 13) AS o_totalprice, TIMESTAMP '1997-01-15' + to_days(CAST(i * 11 % 300 AS INT)) AS o_orderdate,
            ['1-URGENT', '2-HIGH', '5-LOW'][1 + i % 3] AS o_orderpriority FROM range(40) r(i)""",
        "lineitem": """SELECT i::BIGINT AS l_orderkey, (i % 5)::BIGINT AS l_partkey, ((i + j) % 4)::BIGINT AS l_suppkey, j::INT AS l_linenumber,
            (1 + (i * j) % 50)::DOUBLE AS l_quantity, 10.5 * (1 + (i + 3 * j) % 17) AS l_extendedprice, 0.01 * ((i + j) % 10) AS l_discount,
            0.01 * (j % 8) AS l_tax, ['A', 'N', 'R'][1 + (i + j) % 3] AS l_returnflag, ['F', 'O'][1 + j % 2] AS l_linestatus,
            TIMESTAMP '1997-02-10' + to_days(CAST((i * 11 + j * 40) % 400 AS INT)) AS l_shipdate FROM range(40) r(i), range(1, 6) s(j) WHERE j <= 1 + i % 5""",
        "supplier": "SELECT i::BIGINT AS s_suppkey, 'x' AS s_name, (i % 3)::INT AS s_nationkey, 1.0 AS s_acctbal FROM range(4) r(i)",
        "events": """SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' + to_hours(CAST(i * 5 % 700 AS INT)) AS ts, (i % 9)::BIGINT AS user_id,
            ['click', 'view', 'signup', 'error', 'purchase'][1 + i % 5] AS event_type, 1.5 * (i % 40) AS value, '{}' AS props FROM range(200) r(i)""",
    }
    for name, sql in made.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def test_scorecard_input_makes_its_panel_once(spark, tmp_path, monkeypatch):
    """The key map and the marts read one written panel; the rows are those of the SQL."""
    con, made, line_months = tables(tmp_path), [], views.line_months
    monkeypatch.setattr(views, "line_months", lambda t: made.append(t) or line_months(t))
    out = check.compare(spark, con, "scorecard_input", str(tmp_path), entry.queries(), entry.oracle_sql())
    assert out.startswith("ok"), out
    assert len(made) == 1
    assert entry.queries()["limits_mart"](spark, str(tmp_path)).count() > 0 and len(made) > 1  # nothing is left for other queries
