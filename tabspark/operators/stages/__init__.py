"""Fit/transform stages: fit is a few aggregations, transform a stateless projection."""

from tabspark.operators.stages.base import Stage
from tabspark.operators.stages.cleaner import DataCleaner
from tabspark.operators.stages.encoder import EncodingTransformer
from tabspark.operators.stages.missing import MissingValueTransformer
from tabspark.operators.stages.multivariate import IterativeImputer
from tabspark.operators.stages.outliers import OutlierTransformer
from tabspark.operators.stages.rare import RareCategoryTransformer
from tabspark.operators.stages.scaler import FeatureScaler
from tabspark.operators.stages.transforms import FeatureTransformer

__all__ = ["Stage", "DataCleaner", "MissingValueTransformer", "IterativeImputer", "RareCategoryTransformer", "EncodingTransformer",
           "OutlierTransformer", "FeatureTransformer", "FeatureScaler"]
