from .file_stream import progress_frame, run_available_now, stream_new_records

__all__ = ["progress_frame", "run_available_now", "stream_new_records"]
