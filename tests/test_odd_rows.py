"""Queries give the rows of their SQL on rows that the test tables don't hold."""

import duckdb

from cantoria import registry


def test_token_rate_of_odd_documents(spark, tmp_path):
    said = "a b"
    odd = [(1, "", 0), (2, said, 0), (3, None, None), (4, None, 10), (5, said, None), (6, "  ", 2), (7, None, 0), (8, "\n", 1), (None, said, 18), (10, "", 15)]
    # what isn't ASCII ends no word, but begins or ends a text; a vertical tab does neither
    odd += [(20 + i, text, 18) for i, c in enumerate("\v\u00a0\u2003\u3000\u202f\u200b\u0085") for text in (f"{c} a b", f"a{c}b", f"a b {c}", f"{c}a b c d{c}", c)]
    spark.createDataFrame(odd, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    expected = [r[0] for r in con.sql(registry.oracle_sql()["filter_token_rate"]).fetchall()]
    got = [r.doc_id for r in registry.queries()["filter_token_rate"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str) and None in got and {1, 2, 3, 5, 7}.isdisjoint(got)
