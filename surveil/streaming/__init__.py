from surveil.streaming.bars import stream_bars, run_stream_bars, stream_scores, run_stream_scores

__all__ = ["stream_bars", "run_stream_bars", "stream_scores", "run_stream_scores"]
