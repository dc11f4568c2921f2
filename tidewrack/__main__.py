from tidewrack.cli import main

raise SystemExit(main())
