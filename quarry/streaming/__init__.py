from quarry.streaming.transforms import apply_preprocessor_stream, predict_stream

__all__ = ["apply_preprocessor_stream", "predict_stream"]
