"""Table jobs: documents in, rows of one incident table out."""
