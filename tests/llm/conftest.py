import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from small_tables import benchmark, documents, pages  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Workers import the operators by name.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Folder with the small tables; extra columns clash with the operators' inner names."""
    folder = str(tmp_path_factory.mktemp("tables"))
    extra = "row string, key_id long, body string, line string, h long, words string, n_words long"
    more = ("r", 1, "b", "l", 2, "w", 3)
    docs = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), *more) for i, t in documents()]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*p, "d") for p in pages()], "page_id long, url string, html string, digest string") \
        .write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(*b, 1) for b in benchmark()], "item_id long, text string, item int") \
        .write.parquet(f"{folder}/benchmark.parquet")
    marks = [(n, int(n % 4 != 0), 0) for n in range(100, 140)] + [(4, None, None), (None, 1, 0), (5, 0, 0), (5, 1, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_tables(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder
