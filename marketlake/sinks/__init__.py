"""Sinks and load metadata: append loads, run log, watermarks, materialisation."""
