"""DataFrame -> DataFrame operators over unit/cycle panels."""
