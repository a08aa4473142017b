"""Batch and streaming safety screening of conversations, tool calls, documents and pages on Spark.

Everything is a ``DataFrame -> DataFrame`` operator:

* ``functions``  column expressions (regex flavour, line splitting, positional rewriting, links)
* ``operators``  one module per family of rules; each adds decisions, a rewritten text, or both
* ``plans``      ordered stacks of rules, verdicts, audit tables and their analytics
* ``sources``    dimension tables, turn and tool-call sources, sinks
* ``streaming``  the same operators over ``readStream``, and keyed state where order matters
* ``queries``    the registered queries with the SQL that must give the same rows
"""
