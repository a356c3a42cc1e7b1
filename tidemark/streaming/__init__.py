"""Structured Streaming forms of the operators.

* ``windows``    - watermarked window counts, PV/UV, top-N per closed window.
* ``joins``      - stream-stream interval join and reconciliation.
* ``replay``     - ordered-replay stateful processors (blacklist, login
                   patterns, order timeout) on ``transformWithStateInPandas``.
* ``sinks``      - file sinks with checkpoints in the shared checkpoint
                   folder, multi-output split, per-window upsert.
"""
