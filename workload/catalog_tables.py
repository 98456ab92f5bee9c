"""Catalog queries.  The catalog is read off the documents: their sources are the data sources,
a language of a source is a table, and the labels say which of them were seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.projection import World
from workload.registry import query
from zephyrine.operators import catalog

_LABELS = T.StructType([T.StructField("doc_id", T.LongType())])


def _sources(w: World) -> DataFrame:
    described = F.concat(F.count("*").cast("string"), F.lit(" documents"))
    return w.documents.groupBy(F.col("source").alias("name")).agg(
        F.lit("documents").alias("source_type"), described.alias("description")
    )


def _tables(w: World) -> DataFrame:
    described = F.concat(F.max("n_chars").cast("string"), F.lit(" characters at most"))
    return w.documents.groupBy(
        F.col("source").alias("source_name"), F.col("lang").alias("table_name")
    ).agg(F.lit("public").alias("schema_name"), described.alias("description"))


@query(
    """select source as name, 'documents' as source_type, count(*) || ' documents' as description
    from documents group by 1"""
)
def list_sources(w: World) -> DataFrame:
    return catalog.list_sources(_sources(w))


_TABLES_SQL = """select source as source_name, lang as table_name, 'public' as schema_name,
    max(n_chars) || ' characters at most' as description from documents group by 1, 2"""


@query(_TABLES_SQL)
def list_tables(w: World) -> DataFrame:
    return catalog.list_tables(_tables(w))


@query(
    """select distinct source as source_name, 'table:' || lang as target_name, 'load' as
    transformation from documents"""
)
def list_lineage(w: World) -> DataFrame:
    edges = w.documents.groupBy(
        F.col("source").alias("source_name"),
        F.concat(F.lit("table:"), F.col("lang")).alias("target_name"),
    ).agg(F.min("doc_id").alias("edge_order"), F.lit("load").alias("transformation"))
    return catalog.list_lineage(edges)


_COLUMNS = """select lang as table_name, source as column_name,
    case when max(n_chars) > 2000 then 'text' else 'varchar' end as data_type from {t} group by 1, 2"""


@query(
    f"""with p as ({_COLUMNS.format(t="(select * from documents where doc_id in (select doc_id from labels))")}),
    c as ({_COLUMNS.format(t="documents")})
    select table_name, column_name, p.data_type as previous_type, c.data_type as current_type,
    case when p.data_type is null then 'added' when c.data_type is null then 'removed'
    when p.data_type <> c.data_type then 'retyped' else 'same' end as change
    from p full join c using (table_name, column_name)"""
)
def schema_drift(w: World) -> DataFrame:
    def snapshot(docs: DataFrame) -> DataFrame:
        kind = F.when(F.max("n_chars") > 2000, "text").otherwise("varchar")
        return docs.groupBy(
            F.col("lang").alias("table_name"), F.col("source").alias("column_name")
        ).agg(kind.alias("data_type"))

    labels = w.spark.read.schema(_LABELS).parquet(f"{w.dir}/labels.parquet")
    seen = w.documents.join(labels, "doc_id", "left_semi")
    return catalog.schema_drift(snapshot(seen), snapshot(w.documents))
