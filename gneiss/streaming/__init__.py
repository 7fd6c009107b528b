"""Incremental ingestion. The catalog itself is batch: late and republished records are ranked, not watermarked."""
