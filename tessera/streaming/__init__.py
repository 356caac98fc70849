from tessera.streaming.jobs import (every_epoch, hashtag_top_windows, hashtag_window_counts, latest, run_allowed_words,
                                   run_avg_length, run_hashtag_stream, run_popular_words, run_running_aggregate,
                                   run_top_lengths_stream, running_avg_length, top_per_window, word_running_counts)

__all__ = ["every_epoch", "hashtag_top_windows", "hashtag_window_counts", "latest", "run_allowed_words", "run_avg_length",
           "run_hashtag_stream", "run_popular_words", "run_running_aggregate", "run_top_lengths_stream",
           "running_avg_length", "top_per_window", "word_running_counts"]
