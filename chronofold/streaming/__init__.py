from chronofold.streaming.rollup_stream import stream_rollup

__all__ = ["stream_rollup"]
