"""Folders of the driver's tables, for all test modules."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
