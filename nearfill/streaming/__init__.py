from .scoring import impute_stream, score_stream

__all__ = ["impute_stream", "score_stream"]
