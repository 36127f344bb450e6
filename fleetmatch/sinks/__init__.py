"""Writers: quoted CSV text."""
