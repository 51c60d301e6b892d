"""loanmart: consumer-loan data marts expressed as PySpark DataFrame functions.

Layers (each a plain ``DataFrame -> DataFrame`` function, composed lazily so
Catalyst sees one plan per action):

* ``sources``   raw inputs (driver tables, typed seeds, batch stand-ins) and sinks
* ``functions`` Column-level helpers (masking, surrogate keys, calendar maths)
* ``operators`` reusable relational operators (range join, keyed upsert,
                type-2 history merge, table assertions, guarded broadcast)
* ``plans``     the models: staging -> intermediate -> dims/facts -> aggregates
* ``streaming`` the incremental payment load driven by Structured Streaming
"""

from loanmart.params import RunParams

__all__ = ["RunParams"]
