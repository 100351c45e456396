"""Reports: `report(marts, **parameters) -> DataFrame`. Parameters are typed
arguments; nothing is pasted into SQL text."""
