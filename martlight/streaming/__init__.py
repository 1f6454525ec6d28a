"""Structured Streaming: the incremental, watermarked ledger rollup."""
