"""No streaming operators.

The reference reads its activity log as a batch (one JSON read, then actions)
and has no watermark, event-time window or state, so nothing is built here.
A growing log is scored with the batch path: ``plans.modeling.score_log`` on
the stored log, to which ``sources.events.write_activity`` appends (or whose
latest days it replaces).
"""
