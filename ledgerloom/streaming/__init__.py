"""Streaming adapters.

The analysis itself is batch (the original scripts are one-shot batch
queries).  This package only lands new input files incrementally into the
stored tables, so the batch reports can be re-run on current data.
"""
