"""The job that chains the layers."""
