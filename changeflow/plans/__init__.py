"""Complete jobs: a source frame, operators and sinks, chosen by parameters.

A job takes its source as a streaming DataFrame with a ``value`` column, so Kafka,
Kinesis and recorded files are interchangeable. ``every=None`` processes what there is
and stops.
"""
