"""Input files for tests and registered queries; not part of the library."""
