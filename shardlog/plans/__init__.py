"""Configuration, task planning and the pipelines built from both."""
