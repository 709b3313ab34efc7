"""Files of a very long order."""

from pyspark.sql import functions as F
from test_star_schema import N_HOT, tables  # noqa: F401

from flatloom.queries import nested
from flatloom.sources.star_schema import PART_ENTRIES


def test_files_of_a_hot_order_are_bounded(spark, tables, monkeypatch):  # noqa: F811
    """No file has more entries than a part, twice if it has a second document."""
    largest, original = [], nested.quarantined

    def spy(files, model):
        entries = F.size(F.split("value", '"pos":')) - 1
        largest.append(files.agg(F.max(entries)).first()[0])
        return original(files, model)

    monkeypatch.setattr(nested, "quarantined", spy)
    found = nested.several_documents_rejected(spark, str(tables)).collect()
    assert N_HOT > 2 * PART_ENTRIES >= largest[0] > 0
    assert sum(r.files for r in found) == spark.read.parquet(f"{tables}/orders.parquet").count()
