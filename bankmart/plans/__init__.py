"""Model graph and build pipeline."""

from bankmart.plans.project import Project  # noqa: F401
