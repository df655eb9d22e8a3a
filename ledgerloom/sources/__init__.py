"""Inputs and outputs: fixed schemas, loaders, the derived test tables and sinks."""
