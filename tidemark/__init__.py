"""tidemark: a Spark-native, layered order and behaviour warehouse.

Every query is a plain ``DataFrame -> DataFrame`` function that runs the same
way on a batch table and on a Structured Streaming source.  Sources and sinks
are thin adapters around ``spark.read`` / ``readStream`` / ``writeStream``.
"""

from tidemark.session import checkpoint_root, get_session

__all__ = ["checkpoint_root", "get_session"]
