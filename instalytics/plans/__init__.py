"""The 33 feature plans (FE01-FE33) and their lazy assembly."""

from .features import FeatureSet

__all__ = ["FeatureSet"]
