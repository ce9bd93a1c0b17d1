"""cardsentry: card-transaction fraud analytics on Spark (see README.md).

Main entry points (DataFrame in, DataFrame out; batch unless noted):

* ``plans.detection.fraud_alerts(tx)``: union of the three detectors.
* ``operators.above_limit.detect_above_limit(tx, length, slide, allowed, skip)``
* ``operators.low_values.detect_low_values(tx, length, slide)`` and ``p05_by_group``
* ``operators.location.detect_location_jump(tx, length, slide)``, ``velocity_checks``,
  ``suspects_with_nearest``, ``clustered_groups``
* ``operators.trailing.detect_trailing_repeat(tx, hours, bucket_hours)``
* ``plans.feeds``: backtest feeds per card.
* ``sources``: ``fixture.load_tx``, ``json_codec.decode_transactions`` /
  ``alert_json``, ``csv_io`` readers and writers, ``kafka`` option builders.
* ``streaming.detect.start_detection(stream, sink)`` and
  ``streaming.trailing.trailing_repeat_stream(stream)``: Structured Streaming.
* ``python -m cardsentry batch|stream ...``: the job from the command line.

Input rows: ``seq, card_id, ts (TIMESTAMP_NTZ), value (DECIMAL(18,2)),
user_id, lim, lat, lon`` (see ``schema.py``).
"""
