"""Compute operators: difficulty, course factor, distributed row index and the
rolling form index. None of them sorts its output; sinks and reports do."""
