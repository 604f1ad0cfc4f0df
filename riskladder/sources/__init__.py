"""Input schemas, readers, result sinks and TESTDATA-derived stand-in tables."""
