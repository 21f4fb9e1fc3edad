import numpy as np
import pytest
from parity import difference, duck

import __spark_entry__ as contract
from stayledger.llm import oracle_book, query_book
from stayledger.llm.posting_lists import nearest


@pytest.mark.parametrize("name", sorted(oracle_book.oracle_sql()))
def test_same_as_sql(spark, tables_folder, name):
    found = query_book.queries()[name](spark, tables_folder).toPandas()
    assert difference(found, duck(tables_folder).execute(oracle_book.oracle_sql()[name]).df()) is None


def test_all_are_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_recall_on_the_given_table(spark, tables_folder):
    """Against all pairs, in double precision, for every query of the table."""
    rows = spark.read.parquet(f"{tables_folder}/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, float) for r in rows.collect() if r.embedding is not None}
    ids, vec = np.array(sorted(data)), np.stack([data[i] for i in sorted(data)])
    found = {}
    for row in nearest(rows).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    right = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        order = np.lexsort([ids, -(vec @ vec[at])])
        best = [int(i) for i in ids[order] if i != ids[at]][:20]
        right += len(found[int(ids[at])] & set(best))
        total += len(best)
    assert right >= 0.9 * total
