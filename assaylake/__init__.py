"""Clinical-laboratory analytics on Spark: FHIR R4 bulk exports to OMOP CDM v5.4."""

from assaylake.config import CdmSourceInfo, EngineConfig
from assaylake.workspace import Workspace

__all__ = ["CdmSourceInfo", "EngineConfig", "Workspace"]
