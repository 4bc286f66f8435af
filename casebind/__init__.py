"""Link laboratory submissions to a case registry and roster them, as Spark DataFrame plans."""

from casebind.settings import EngineConfig, LinkConfig

__all__ = ["EngineConfig", "LinkConfig"]
