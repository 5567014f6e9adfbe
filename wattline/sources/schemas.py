"""Types of the tables between the stages. CSV sources are read as text and cast by name."""

from __future__ import annotations

from pyspark.sql import types as T

from wattline import constants as C

RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in C.RAW_COLUMNS if c not in ("adv_ut_list", "ent_cd_list", "defect_range", "LABEL")]
    + [
        T.StructField("adv_ut_list", T.ArrayType(T.DoubleType())),
        T.StructField("ent_cd_list", T.ArrayType(T.StringType())),
        T.StructField("defect_range", T.IntegerType()),
        T.StructField("LABEL", T.IntegerType()),
    ]
)

COMBINED = T.StructType([*RAW.fields, T.StructField("SOURCE", T.StringType())])

TRAINING = T.StructType(
    [T.StructField(c, T.StringType()) for c in C.CATEGORICAL_FEATURES]
    + [T.StructField(c, T.DoubleType()) for c in C.NUMERIC_FEATURES]
    + [T.StructField("LABEL", T.IntegerType())]
)
