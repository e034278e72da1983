"""The smallest data directory, for tests that run whole queries."""

SMALL_SF = "/root/testdata/sf0.001"
