"""Inputs: explicit schemas (``schemas``), node JSON readers (``rpc_json``), test-table adapters (``testdata``)."""
