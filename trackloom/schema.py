"""Schemas of the input files. The field names of the formats."""

from pyspark.sql import types as T

SHAPE = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("points", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("group_id", T.StringType()),
        T.StructField("shape_type", T.StringType()),
        T.StructField("flags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

LABELME = T.StructType(
    [
        T.StructField("imagePath", T.StringType()),
        T.StructField("imageWidth", T.IntegerType()),
        T.StructField("imageHeight", T.IntegerType()),
        T.StructField("shapes", T.ArrayType(SHAPE)),
    ]
)

INTERACTION_COLUMNS = [
    "video_id",
    "frame_id",
    "x1",
    "y1",
    "x2",
    "y2",
    "x1_2",
    "y1_2",
    "x2_2",
    "y2_2",
    "action_id",
    "person_id",
    "instance_id",
]

ALIGNMENT = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("sh_index", T.LongType()),
        T.StructField("sh_file", T.StringType()),
        T.StructField("ms_index", T.LongType()),
        T.StructField("ms_file", T.StringType()),
        T.StructField("k", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)
