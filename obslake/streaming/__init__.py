from obslake.streaming.hottest import stream_hottest
from obslake.streaming.improvements import ROCKSDB, stream_improvements
from obslake.streaming.ingest import stream_ingest

__all__ = ["ROCKSDB", "stream_hottest", "stream_improvements", "stream_ingest"]
