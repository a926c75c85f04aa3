"""Drivers that put operators together: metadata harvest, read processing and the merging of data sets."""
