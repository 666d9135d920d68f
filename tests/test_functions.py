from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import paths, times
from quayside.functions.values import all_string, column_names, json_field
from quayside.params import LoadParams, parse_load_id
from quayside.sources.relations import relation
from tools import LANDING, TEMPLATE, values

PARAMS = LoadParams("Src", "DE", "eu", "20220117101112")


def one(spark, column, **fields):
    ddl = ", ".join(f"{name} string" for name in fields) or "x string"
    return relation(spark, [fields], ddl).select(column.alias("v")).first().v


def test_params():
    assert PARAMS.process_id == "Src_eu"
    assert PARAMS.source_cluster == "src-de"
    assert PARAMS.current == datetime(2022, 1, 17, 10, 11, 12, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        parse_load_id("2022-01-17")


def test_load_id_texts(spark):
    rows = relation(
        spark, [{"x": "20220117101112"}, {"x": "20221317101112"}, {"x": "abc"}, {"x": None}],
        "x string",
    ).select(
        times.file_watermark_text(F.col("x")).alias("file"),
        times.entity_watermark_text(F.col("x")).alias("entity"),
    )
    assert [tuple(row) for row in rows.collect()] == [
        ("2022-01-17T10:11:12", "2022-01-17T10:11:12.000Z"),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_bound_takes_the_column_type(spark):
    df = relation(
        spark,
        [{"a": None, "b": None, "c": None}],
        "a timestamp, b timestamp_ntz, c string",
    )
    at = datetime(2022, 1, 17, 10, 11, 12, 345000)
    kinds = df.select(
        times.bound(df, "a", at).alias("a"),
        times.bound(df, "b", at).alias("b"),
        times.bound(df, "c", at).alias("c"),
    )
    assert [field.dataType for field in kinds.schema] == [
        T.TimestampType(), T.TimestampNTZType(), T.StringType(),
    ]
    assert kinds.first().b == at
    assert kinds.first().c == "2022-01-17T10:11:12.345Z"


@pytest.mark.parametrize(
    "template, path, entity",
    [
        (TEMPLATE, "src/de/src_de_acc/a/f1.parquet", "acc"),
        (TEMPLATE, "src/de/src_de_my_ent/a/f5.parquet", "my_ent"),
        (TEMPLATE, "src/de/src_de/a/f5.parquet", None),
        (TEMPLATE, "f6.parquet", None),
        ("<source-system>/<entity>/<file>", "src/my_ent/f.parquet", "my_ent"),
        ("<entity>/<file>", "acc/f.parquet", "acc"),
        ("in_<cluster>_<entity>/<file>", "in_de_acc/f.parquet", "de_acc"),
    ],
)
def test_entity_of_key(spark, template, path, entity):
    assert one(spark, paths.EntityRule.of(template).entity(F.col("p")), p=path) == entity


def test_template_without_entity():
    with pytest.raises(ValueError):
        paths.EntityRule.of("<source-system>/<file>")


@pytest.mark.parametrize(
    "path, fits",
    [
        ("src/de/src_de_acc/f.parquet", True),
        ("src/de/src_de_acc", False),
        ("f6.parquet", False),
        ("src/de/acc/f.parquet", False),
    ],
)
def test_mappable(spark, path, fits):
    rule = paths.EntityRule.of(TEMPLATE)
    assert one(spark, paths.is_mappable(F.col("p"), rule), p=path) is fits


@pytest.mark.parametrize(
    "path, name, parent",
    [
        ("a/b/c.parquet", "c.parquet", "a/b"),
        ("a/b/", "", "a/b"),
        ("c.parquet", "c.parquet", "c.parquet"),
    ],
)
def test_name_and_parent(spark, path, name, parent):
    assert one(spark, paths.file_name(F.col("p")), p=path) == name
    assert one(spark, paths.parent(F.col("p")), p=path) == parent


@pytest.mark.parametrize(
    "path, data",
    [
        ("src/de/acc/f.parquet", True),
        ("src/de/acc/", False),
        ("src/de/acc_$folder$", False),
        ("src/$folder$/f", True),
        ("src/de/folder$", True),
    ],
)
def test_data_file(spark, path, data):
    assert one(spark, paths.is_data_file(F.col("p")), p=path) is data


def test_templates(spark):
    target = paths.landing_path(LANDING, "Src", "DE", "20220117101112", F.col("e"), F.col("f"))
    assert one(spark, target, e="Ord", f="p.parquet") == "Src/DE/20220117101112/Ord/p.parquet"
    # A value that looks like a token is data, not a token.
    assert one(spark, target, e="<file>", f="p") == "Src/DE/20220117101112/<file>/p"
    assert paths.pull_folder(TEMPLATE, PARAMS, "Ord") == "src/de/src_de_ord/20220117101112/"
    assert paths.landed_root("Src/<country>/<loadid>/", PARAMS) == "src/de/20220117101112/"
    assert paths.database_name("land_<source_system>_<country>", PARAMS) == "land_Src_DE"
    assert one(spark, paths.metadata_key(F.lit("DE"), F.col("e")), e="OrD") == "DE_ord"
    name = paths.pull_folder_name(F.lit("Src"), F.lit("DE"), F.col("e"))
    assert one(spark, name, e="Ord") == "src_de_ord"


def test_key_of_a_file(spark):
    found = paths.key_under("/r/src", F.col("u"))
    assert one(spark, found, u="file:/r/src/a%20b+c/x%5B1%5D.parquet") == "a b+c/x[1].parquet"
    found = paths.key_under("/src/", F.col("u"))
    assert one(spark, found, u="s3a://b/src/src/f") == "src/f"
    assert one(spark, found, u="file:///src/f") == "f"
    with pytest.raises(Exception, match="is not below /src/"):
        one(spark, found, u="s3a://b/other/src/f")


def test_all_string(spark):
    df = spark.sql("select 1 as a, true as B, array(1, 2) as c, 'x' as extra")
    found = all_string(df, ["b", "missing", "a"])
    assert found.columns == ["b", "missing", "a"]
    assert all(field.dataType == T.StringType() for field in found.schema)
    assert tuple(found.first()) == ("true", None, "1")


def test_json_and_column_names(spark):
    assert one(spark, json_field(F.col("j"), "k"), j='{"k": 5}') == "5"
    assert one(spark, json_field(F.col("j"), "k"), j='{"x": 5}') is None
    df = relation(
        spark, [{"m": [{"name": "id"}, {"name": "ts"}]}], "m array<struct<name:string>>"
    )
    assert values(df.select(column_names(F.col("m")))) == [(["id", "ts"],)]
