"""Composite jobs: one public function per job, DataFrames in and out."""
