"""The load pipeline, the reports, the forecast and the source views."""
