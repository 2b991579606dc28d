"""Sources and sinks bound to the logical topic names of a pipeline spec."""

from cdcflow.sources.topics import TopicBinding, read_jdbc_table, read_topic, write_topic  # noqa: F401
