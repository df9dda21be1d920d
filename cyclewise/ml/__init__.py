"""Spark ML stages and model catalogue: one PipelineModel carries features, scaler and regressor."""
