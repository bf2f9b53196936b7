"""Sources and sinks: corpora, generated text, the layered lake, logs, runs."""
