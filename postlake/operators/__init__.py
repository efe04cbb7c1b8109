"""DataFrame -> DataFrame operators.  Nothing here triggers an action except
where documented (size checks before a broadcast, loop control of iterative
operators)."""
