"""Streaming.

The reference has no streams: no watermarks, windows over event time, late
data or stateful operators (its only notion of "late" is the static cutoff
date of a prediction, handled by the as-of operators). Nothing is invented
here; the batch operators are plain DataFrame functions, so a caller with a
request stream can apply them per micro-batch with ``foreachBatch``.
"""
