"""The deliverables: one function per query, cleaning step, quality rule and report."""
