"""Readings analytics on PySpark DataFrames."""

from loamline.config import Calibration, PipelineConfig, ValueRange

__all__ = ["Calibration", "PipelineConfig", "ValueRange"]
