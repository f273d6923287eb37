"""Incremental refresh of the day-partitioned cost views.

The reports are daily batch views; the reference defines no streaming
operator (no watermark, window or state). This package only drives the
refresh: new fact files arrive, the days they touch are rebuilt.
"""
