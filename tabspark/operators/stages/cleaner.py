from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalars import to_timestamp_or_null
from tabspark.functions.types import family_of, is_fractional, is_integer, q
from tabspark.operators.aggregate import collect_aggregates
from tabspark.operators.duplicates import duplicate_columns, keep_first
from tabspark.operators.stages.base import Stage


class DataCleaner(Stage):
    """Drops duplicate training rows and duplicate columns, and standardises column types.

    A column of another type than the learned one is cast if no value is lost, which takes one look at the data; in a stream, values that
    do not fit become null.
    """

    def __init__(self, drop_row_duplicates: bool = True, drop_col_duplicates: bool = True,
                 datetime_cols: list[str] | None = None, coerce_objects_to_category: bool = True):
        self.drop_row_duplicates, self.drop_col_duplicates = drop_row_duplicates, drop_col_duplicates
        self.datetime_cols = list(datetime_cols or [])
        self.coerce_objects_to_category = coerce_objects_to_category

    def _learn(self, df: DataFrame) -> None:
        cols = self.feature_names_in_
        values = {} if self.changes_rows else self.seen.get("values", {})
        self.duplicate_features_ = duplicate_columns(df, cols, values) if self.drop_col_duplicates and cols else []
        self.feature_names_out_ = [c for c in cols if c not in self.duplicate_features_]
        self.column_types_ = {}
        for c in self.feature_names_out_:
            dtype = df.schema[c].dataType
            if c in self.datetime_cols:
                self.column_types_[c] = "timestamp"
            elif is_integer(dtype):
                self.column_types_[c] = "bigint"
            elif is_fractional(dtype):
                self.column_types_[c] = "double"
            elif family_of(dtype) == "categorical" and self.coerce_objects_to_category:
                self.column_types_[c] = "string"

    def _apply(self, df: DataFrame) -> DataFrame:
        df = df.select([q(c) for c in df.columns if c not in self.duplicate_features_])
        types = {f.name: f.dataType for f in df.schema.fields}
        new, risky = {}, {}
        for c, wanted in self.column_types_.items():
            if c not in types or types[c].simpleString() == wanted:
                continue
            if wanted == "timestamp":
                new[c] = to_timestamp_or_null(q(c)) if family_of(types[c]) != "datetime" else q(c).cast("timestamp")
            elif wanted == "string" or (family_of(types[c]) == "numeric" and wanted == "double"):
                new[c] = q(c).cast(wanted)
            elif is_integer(types[c]) and wanted == "bigint":
                new[c] = q(c).cast(wanted)
            else:
                risky[c] = q(c).try_cast(wanted)
        if risky and df.isStreaming:
            new.update(risky)  # what does not fit the learned type is null: a stream cannot be looked at first
        elif risky:
            # A cast that would lose a value keeps the original type.
            whole = {c: (q(c) == e if family_of(types[c]) == "numeric" else e.isNotNull()) for c, e in risky.items()}
            lost = collect_aggregates(df, {c: F.count_if(q(c).isNotNull() & ~F.coalesce(whole[c], F.lit(False)))
                                           for c in risky})
            new.update({c: e for c, e in risky.items() if not lost[c]})
        return self.replace(df, new) if new else df

    def fit_transform(self, df: DataFrame, target: str | None = None, key: str | None = None) -> DataFrame:
        self.target, self.key = target, key
        if self.drop_row_duplicates:
            df, self.changes_rows = keep_first(df, self.features(df), key)
        return self.fit(df, target, key).transform(df)

    def seen_out(self) -> dict:
        same = [c for c in self.feature_names_out_ if c not in self.datetime_cols]
        return {k: {c: v[c] for c in same if c in v} for k, v in self.seen.items()}

    def get_reports(self) -> dict:
        return {"cleaning": {"duplicate_columns": self.duplicate_features_, "column_types": self.column_types_}}
