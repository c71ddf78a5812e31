"""Structured Streaming entry points for incremental survey files."""

from .survey_stream import (cleaned_worth_stream, read_survey_stream, start_cheaper_counts,
                            start_cleaned_sink)

__all__ = ["cleaned_worth_stream", "read_survey_stream", "start_cheaper_counts",
           "start_cleaned_sink"]
