"""DataFrame operators: loaders, relations, versions, scans, key space, files, audit."""
