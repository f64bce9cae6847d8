import pytest
from oracle import connect, rows

from folioforge.llm import queries


# Numbers of rows that queries without SQL must have, and the columns that are never null.
COUNTS = {
    "p3_normalized": lambda c: c.execute("SELECT (SELECT count(*) FROM individual_caption) + (SELECT count(*) FROM panel_list)").fetchone()[0],
    "p3_classes": lambda c: c.execute("SELECT (SELECT count(figure_caption) FROM individual_caption) + (SELECT count(panel_caption) FROM panel_list)").fetchone()[0],
    "p4_found": lambda c: c.execute("SELECT count(*) FROM data_source WHERE trim(database) <> '' AND database NOT IN (SELECT name FROM identifiers)").fetchone()[0],
    "p6_usage": lambda c: 1,
    "p8_found": lambda c: 0,  # the smallest data hold no such page
    "p8_shares": lambda c: c.execute("SELECT count(*) FROM documents WHERE text <> ''").fetchone()[0],
}
KEYS = {"p3_normalized": ["field_name", "id"]}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_and_equals_its_sql(spark, small_data, name):
    got = queries.QUERIES[name](spark, small_data).toPandas()
    if name in queries.ORACLES:
        assert rows(got) == rows(connect(small_data).execute(queries.ORACLES[name]).df())
    else:
        assert len(got) == COUNTS[name](connect(small_data)) if name in COUNTS else len(got) > 0
        assert not got.duplicated().any() and got[KEYS.get(name, list(got.columns))].notna().all().all()


def test_columns_of_found_queries(spark, small_data):
    want = {
        "p1_found": ["table_name", "row_id"], "p3_found": ["field_name", "id_a", "id_b"], "p4_found": ["data_source_id", "registry_id"],
        "p5_found": ["section_id", "field_name"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id"],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, small_data).columns == columns
