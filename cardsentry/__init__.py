"""cardsentry: fraud signals from payment events on Spark.

Every transformation is a plain ``DataFrame -> DataFrame`` function that runs
on batch and streaming input alike; ``cardsentry.streaming`` binds them to
Structured Streaming sources and sinks, ``cardsentry.plans`` wires the
dataset graph (bronze -> silver -> gold -> notifications).

Main entry points:

* ``plans.graph.run_graph(spark, Layout(root), kafka_df, customers_df, watchlist_dir)``
  -- the whole dataset graph as named tables, one checkpointed query per table;
* ``sources.kafka.read_kafka_stream`` / ``sources.files.stream_json_records`` /
  ``sources.jdbc.read_jdbc_table`` -- the inputs;
* ``operators.layers`` (bronze/silver), ``operators.alerts`` (gold),
  ``operators.windows`` (counts), ``operators.notify`` (messages),
  ``operators.quality`` (expectations);
* ``streaming.matcher.WatchlistMatcher`` -- watchlist matching without
  unbounded join state; ``streaming.outbox.OutboxWriter`` and
  ``streaming.delivery.deliver`` -- notifications;
* ``session.build_session`` / ``session.CLUSTER_CONF`` -- settings.
"""

__version__ = "0.1.0"
